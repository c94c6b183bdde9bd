"""Text normalisation shared by the dimensions and the fact load."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_text(c: Column | str) -> Column:
    """Trim spaces on both sides; blank becomes NULL (tabs are kept)."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def norm_key(c: Column | str) -> Column:
    """Join key where NULL and blank are the same value (postcode, type)."""
    return F.coalesce(F.trim(_col(c)), F.lit(""))


#: Case and trailing blanks do not count, as in the server's default collation.
SERVER_COLLATION = "UTF8_LCASE_RTRIM"


def ci_key(c: Column | str) -> Column:
    """The text as a key under the server's collation: joins, groupings and
    partitionings on it compare by the collation; the spelling is kept."""
    return F.collate(_col(c), SERVER_COLLATION)


def contains_any(c: Column | str, needles, case_insensitive: bool = False) -> Column:
    """True when the text contains any of the needles (LIKE '%x%' OR ...)."""
    col = _col(c)
    if case_insensitive:
        col = F.collate(col, "UTF8_LCASE")
    cond = None
    for n in needles:
        hit = col.contains(F.lit(n))
        cond = hit if cond is None else (cond | hit)
    return F.coalesce(cond, F.lit(False))
