"""Column expressions (built-in Spark functions only, no Python UDFs)."""

from spendstar.functions.parsing import (
    month_label,
    parse_amount,
    parse_day_first_date,
)
from spendstar.functions.text import ci_key, contains_any, norm_key, norm_text

__all__ = [
    "ci_key",
    "contains_any",
    "month_label",
    "norm_key",
    "norm_text",
    "parse_amount",
    "parse_day_first_date",
]
