"""Tolerant parsing, redaction, reject list, dedup: row-level rules."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from spendstar.constants import SPEND_COLUMNS
from spendstar.functions.parsing import month_label, parse_amount, parse_day_first_date
from spendstar.operators.cleaning import dedup, redact, reject_suppliers


@pytest.mark.parametrize("text, expected", [
    ("01/02/2013", dt.date(2013, 2, 1)),
    ("1/2/2013", dt.date(2013, 2, 1)),
    (" 1/2/2013 ", dt.date(2013, 2, 1)),
    ("31/02/2013", None),
    ("02/13/2013", None),
    ("1/2/13", None),
    ("2013-02-01", None),
    ("01-02-2013", None),
    ("01/02/2013 10:00", None),
    ("", None),
    (None, None),
])
def test_day_first_dates(spark, text, expected):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(parse_day_first_date("d")).first()[0] == expected


@pytest.mark.parametrize("text, expected", [
    ("100.00", D("100.00")),
    ("12.345", D("12.35")),
    ("-0.005", D("-0.01")),
    (" 7 ", D("7.00")),
    ("1,234.56", None),
    ("£12", None),
    ("(100.00)", None),
    ("1e3", None),
    ("12345678901234567.00", None),
    ("", None),
    (None, None),
])
def test_amounts(spark, text, expected):
    df = spark.createDataFrame([(text,)], "a string")
    assert df.select(parse_amount("a")).first()[0] == expected


def test_month_label(spark):
    df = spark.createDataFrame([(2013, 2)], "y int, m int")
    assert df.select(month_label("y", "m")).first()[0] == "February 2013"


def _staging(spark, rows):
    full = [tuple(r.get(c) for c in SPEND_COLUMNS) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in SPEND_COLUMNS))


def test_reject_keeps_null_and_matches_trimmed(spark):
    df = _staging(spark, [{"Supplier": " BAD CO "}, {"Supplier": None}, {"Supplier": "GOOD"},
                          {"Supplier": "bad co"}])
    rejects = spark.createDataFrame([("BAD CO ",)], "SupplierName string")
    kept = sorted((r.Supplier or "<null>") for r in reject_suppliers(df, rejects).collect())
    assert kept == ["<null>", "GOOD", "bad co"]
    kept_ci = reject_suppliers(df, rejects, case_insensitive=True).collect()
    assert sorted((r.Supplier or "<null>") for r in kept_ci) == ["<null>", "GOOD"]


def test_redaction_only_touches_supplier(spark):
    df = _staging(spark, [{"Supplier": "x Personal Expense y", "Description": "Name Withheld"},
                          {"Supplier": "Name Withheld"}, {"Supplier": None},
                          {"Supplier": "personal expense"}])
    out = redact(df).collect()
    assert [r.Supplier for r in out] == ["REDACTED_PERSONAL_EXPENSE", "REDACTED_PERSONAL_EXPENSE",
                                          None, "personal expense"]
    assert out[0].Description == "Name Withheld"


def test_dedup_null_keys_equal_and_survivor_is_first_in_order(spark):
    rows = [
        {"TransactionNumber": None, "Supplier": None, "Amount": None, "DateOfPayment": None,
         "Department": "B"},
        {"TransactionNumber": None, "Supplier": None, "Amount": None, "DateOfPayment": None,
         "Department": None},
        {"TransactionNumber": None, "Supplier": None, "Amount": None, "DateOfPayment": None,
         "Department": "A"},
        {"TransactionNumber": "T", "Supplier": "S", "Department": "Z"},
    ]
    out = dedup(_staging(spark, rows)).collect()
    assert len(out) == 2
    survivor = [r for r in out if r.TransactionNumber is None][0]
    assert survivor.Department is None  # NULLs first


def test_dedup_keeps_padded_twin(spark):
    rows = [{"TransactionNumber": "T", "Supplier": "ACME"},
            {"TransactionNumber": "T", "Supplier": "ACME"},
            {"TransactionNumber": "T", "Supplier": " ACME"}]
    assert dedup(_staging(spark, rows)).count() == 2


def test_dedup_hot_key_is_limited_before_the_shuffle(spark):
    rows = [{"TransactionNumber": "HOT", "Supplier": "S", "Department": str(i)} for i in range(200)]
    df = _staging(spark, rows).repartition(8)
    out = dedup(df)
    assert out.count() == 1
    assert out.first().Department == "0"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) and final


def test_flagged_rejects_equal_anti_join(spark):
    from spendstar.operators.cleaning import mark_rejected
    df = _staging(spark, [{"Supplier": " BAD CO "}, {"Supplier": None}, {"Supplier": "GOOD"},
                          {"Supplier": "BAD CO"}])
    rejects = spark.createDataFrame([("BAD CO",), ("BAD CO ",), (None,)], "SupplierName string")
    flagged = mark_rejected(df, rejects)
    assert flagged.count() == 4  # duplicate list entries never multiply rows
    kept = flagged.where("NOT _rejected").drop("_rejected")
    assert sorted(map(repr, kept.collect())) == sorted(
        map(repr, reject_suppliers(df, rejects).collect()))
