"""Surveillance operators: plain ``DataFrame -> DataFrame`` functions."""
