"""Readers for the surveillance inputs and the delimited staging format."""
