"""Structured Streaming form of the daily run (see ``daily``)."""

from tradewatch.operators.feed import replace_days
from tradewatch.streaming.daily import batch_handler, start, versioned_handler

__all__ = ["batch_handler", "replace_days", "start", "versioned_handler"]
