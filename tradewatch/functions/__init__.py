"""Column expressions shared by the operators (all built-in Spark functions)."""

from tradewatch.functions.dates import beyond_horizon, is_weekday, month_start
from tradewatch.functions.numeric import round_half_even
from tradewatch.functions.text import ilike_any, in_text, norm, not_in_text, same_text

__all__ = [
    "beyond_horizon", "ilike_any", "in_text", "is_weekday", "month_start", "norm", "not_in_text", "round_half_even", "same_text",
]
