"""Server-style case-insensitive matching (case_insensitive=True) end to end."""

from __future__ import annotations

from decimal import Decimal as D

import pytest

from spendstar.constants import SPEND_COLUMNS
from spendstar.operators.cleaning import dedup
from spendstar.plans import reports
from spendstar.plans.warehouse import build_warehouse

FIELDS = ("Department", "Entity", "DateOfPayment", "ExpenseType", "ExpenseArea", "Supplier",
          "TransactionNumber", "Amount", "SupplierPostCode", "SupplierType")
ROWS = [
    ("BIS", "HQ", "01/01/2013", "Travel", "North", "ACME LTD", "T1", "10.00", "A1", "SME"),
    ("BIS", "HQ", "01/01/2013", "Travel", "North", "Acme Ltd ", "t1", "10.00", "A1", "SME"),
    ("bis", "hq", "02/01/2013", "travel", "NORTH", "acme ltd", "T2", "5.00", "a1", "sme"),
    ("BIS", "HQ", "03/01/2013", "Rent", "South", "Bad Co", "T3", "7.00", "B1", "SME"),
]


def _staging(spark):
    rows = [tuple(dict(zip(FIELDS, r)).get(c) for c in SPEND_COLUMNS) for r in ROWS]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SPEND_COLUMNS))


@pytest.fixture(scope="module")
def rejects(spark):
    return spark.createDataFrame([("BAD CO",)], "SupplierName string")


def test_binary_default_keeps_case_variants(spark, rejects):
    wh = build_warehouse(_staging(spark), rejects)
    assert wh.clean.count() == 4            # nothing rejected, no duplicates
    assert wh.dims["DimSupplier"].count() == 4
    assert wh.dims["DimExpenseType"].count() == 3


def test_case_insensitive_merges_case_variants(spark, rejects):
    wh = build_warehouse(_staging(spark), rejects, case_insensitive=True)
    assert wh.counters["StagingRowCount_After"] == 3   # 'Bad Co' rejected
    assert wh.clean.count() == 2                        # 'Acme Ltd ' / t1 is a duplicate
    sups = [tuple(r)[1:] for r in wh.dims["DimSupplier"].orderBy("SupplierID").collect()]
    assert sups == [("ACME LTD", "A1", "SME")]          # smallest spelling per class
    assert [r.ExpenseType for r in wh.dims["DimExpenseType"].collect()] == ["Travel"]
    assert [r.ExpenseArea for r in wh.dims["DimExpenseArea"].collect()] == ["NORTH"]
    assert [tuple(r)[1:] for r in wh.dims["DimOrganisation"].collect()] == [("BIS", "HQ")]
    assert wh.fact.count() == 2 and wh.counters["NoSupplierMatch"] == 0
    assert [tuple(r) for r in reports.top_suppliers(wh).collect()] == [("ACME LTD", D("15.00"))]


def test_case_insensitive_dedup_keeps_the_map_side_limit(spark):
    df = _staging(spark).repartition(4)
    out = dedup(df, case_insensitive=True)
    out.collect()
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
