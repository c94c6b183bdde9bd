"""Tolerant parsing: a value that does not parse becomes NULL, the row stays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendstar.constants import AMOUNT_TYPE, DAY_FIRST_DATE, PLAIN_NUMBER


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_day_first_date(c: Column | str, fmt: str = DAY_FIRST_DATE) -> Column:
    """dd/mm/yyyy text to DATE; impossible dates and other shapes give NULL."""
    return F.try_to_date(F.trim(_col(c)), fmt)


def parse_amount(c: Column | str, dtype=AMOUNT_TYPE) -> Column:
    """Plain decimal text to DECIMAL(18,2), rounded half away from zero.

    Thousands separators, currency signs, brackets, exponents and overflow
    all give NULL.  The regex guard keeps exponent forms out, which a bare
    cast would accept.
    """
    text = F.trim(_col(c))
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast(dtype))


def month_label(year: Column | str, month: Column | str) -> Column:
    """'February 2013' from year and month numbers."""
    return F.date_format(F.make_date(_col(year), _col(month), F.lit(1)), "MMMM yyyy")
