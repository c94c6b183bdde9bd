"""Randomised checks of the two tolerant parsers against plain Python rules.

Hypothesis draws a batch of inputs; Spark parses the whole batch in one
DataFrame, and every value must equal what the rule says (M2, M3).
"""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from spendstar.functions.parsing import parse_amount, parse_day_first_date

DATES = st.tuples(st.integers(0, 35), st.integers(0, 14), st.integers(1, 9999),
                  st.booleans(), st.booleans())


def _expected_date(d: int, m: int, y: int):
    # any real calendar day with a four-digit year (0001-9999), as a SQL date
    try:
        return dt.date(y, m, d)
    except ValueError:
        return None


@settings(max_examples=3, deadline=None)
@given(st.lists(DATES, min_size=50, max_size=200))
def test_day_first_dates_follow_the_calendar(spark, batch):
    texts, expected = [], []
    for d, m, y, pad_day, pad_month in batch:
        text = f"{d:02d}" if pad_day else str(d)
        text += "/" + (f"{m:02d}" if pad_month else str(m)) + f"/{y:04d}"
        texts.append(text)
        expected.append(_expected_date(d, m, y))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_day_first_date("t")).collect()]
    assert got == expected


AMOUNTS = st.decimals(min_value=Decimal("-9999999999999999"),
                      max_value=Decimal("9999999999999999"),
                      allow_nan=False, allow_infinity=False, places=3)


@settings(max_examples=3, deadline=None)
@given(st.lists(AMOUNTS, min_size=50, max_size=200))
def test_plain_amounts_round_half_away_from_zero(spark, batch):
    texts = [format(a, "f") for a in batch]
    expected = [a.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) for a in batch]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_amount("t")).collect()]
    assert got == expected


@settings(max_examples=3, deadline=None)
@given(st.lists(st.sampled_from(["1e3", "1,234.56", "£12", "(1.00)", "12-", "1.2.3", "abc",
                                 "--1", "+", ".", ""]), min_size=10, max_size=50))
def test_non_plain_amounts_are_null(spark, batch):
    df = spark.createDataFrame([(t,) for t in batch], "t string")
    assert all(r[0] is None for r in df.select(parse_amount("t")).collect())
