"""End to end on the toy spend file: files -> warehouse -> reports.

Expected values are the hand-checked answers of FIXTURES.md section 4.
The spend rows go through a real tab-delimited file and the reject list
through a real XML file, as in the reference's load.
"""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import toy
from spendstar.operators.audit import clean_vs_fact, integrity
from spendstar.operators.cleaning import duplicate_audit
from spendstar.operators.fact import unmatched
from spendstar.plans import reports
from spendstar.plans.warehouse import build_warehouse, clean_steps
from spendstar.sources.delimited import read_spend, write_spend
from spendstar.sources.reject_list import read_reject_list


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("toy")
    write_spend(toy.staging(spark).coalesce(1), str(d / "spend"))
    (d / "rejects.xml").write_text(
        '<?xml version="1.0" encoding="UTF-8"?>\n<Suppliers>\n'
        + "".join(f'    <Supplier SupplierName="{n}" />\n' for n in toy.REJECTS)
        + "</Suppliers>\n")
    return str(d / "spend"), str(d / "rejects.xml")


@pytest.fixture(scope="module")
def loaded(spark, files):
    spend_path, xml_path = files
    staging = read_spend(spark, spend_path)
    rejects = read_reject_list(spark, xml_path)
    return staging, rejects


@pytest.fixture(scope="module")
def wh(loaded):
    staging, rejects = loaded
    return build_warehouse(staging.drop("_corrupt_record", "source_file"), rejects)


def test_step_counts(loaded, wh):
    staging, rejects = loaded
    steps = clean_steps(staging, rejects)
    assert staging.count() == 14
    assert steps.rejected.count() == 13
    assert steps.redacted.where(F.col("Supplier") == "REDACTED_PERSONAL_EXPENSE").count() == 2
    assert steps.typed.where(F.col("DateOfPayment").isNull()).count() == 1
    assert steps.typed.where(F.col("Amount").isNull()).count() == 1
    assert wh.counters == {
        "StagingRowCount": 14, "StagingRowCount_After": 13, "RedactedSupplierRows": 2,
        "CleanRowCount": 13, "InvalidDateCount": 1, "InvalidAmountCount": 1,
        "InvalidSupplierCount": rejects.count(), "DuplicateGroups": 1, "RowCount_AfterDeDup": 12,
        "MalformedRows": 0,
        "CleanRows": 12, "NoOrganisationMatch": 1, "NoSupplierMatch": 1,
        "NoExpenseTypeMatch": 0, "NoExpenseAreaMatch": 0, "NoDateMatch": 1,
        "FactRows": 9, "MaxDateID": 6}


def test_duplicate_audit_and_dedup(loaded, wh):
    staging, rejects = loaded
    typed = clean_steps(staging, rejects).typed
    dups = [tuple(r) for r in duplicate_audit(typed).collect()]
    assert dups == [("T01", "ACME LTD", D("100.00"), dt.date(2013, 1, 15), 2)]
    assert wh.clean.count() == 12
    # the padded twin is a different natural key and survives
    assert wh.clean.where(F.col("Supplier") == " ACME LTD").count() == 1


def test_dimensions(wh):
    sizes = {n: d.count() for n, d in wh.dims.items()}
    assert sizes == {"DimOrganisation": 2, "DimSupplier": 7, "DimExpenseType": 3,
                     "DimExpenseArea": 3, "DimDate": 6}
    orgs = [tuple(r) for r in wh.dim_organisation.orderBy("OrganisationID").collect()]
    assert orgs == [(1, "BIS", None), (2, "BIS", "HQ")]
    sups = [tuple(r)[1:] for r in wh.dim_supplier.orderBy("SupplierID").collect()]
    assert sups == [(None, "B1", "SME"), ("ACME LTD", None, None), ("ACME LTD", "AB1", "SME"),
                    ("BETA", "B1", "SME"), ("BETA", "B2", "SME"), ("GAMMA", "G1", "SME"),
                    ("REDACTED_PERSONAL_EXPENSE", None, "SME")]
    dates = wh.dim_date.orderBy("DateID").collect()
    assert [r.DateID for r in dates] == [1, 2, 3, 4, 5, 6]
    assert dates[0].FullDate == dt.date(2013, 1, 15) and dates[0].MonthName == "January"


def test_fact_and_diagnostics(wh):
    txns = sorted(r.TransactionNumber for r in wh.fact.collect())
    assert txns == ["T01", "T01", "T03", "T07", "T08", "T09", "T10", "T11", "T12"]
    assert wh.fact.where(F.col("TransactionNumber") == "T03").first().Amount is None
    lost = {r.dimension: r.unmatched_rows for r in unmatched(wh.clean, wh.dims).collect()}
    assert lost == {"Organisation": 1, "Supplier": 1, "ExpenseType": 0, "ExpenseArea": 0,
                    "Date": 1}
    audit = {r.metric: r.value for r in clean_vs_fact(wh.clean, wh.fact).collect()}
    assert audit == {"CleanRows": 12, "FactRows": 9, "LostRows": 3}
    assert all(r.violations == 0 for r in integrity(wh.dims, wh.numbered_fact).collect())


def test_top_suppliers(wh):
    rows = [tuple(r) for r in reports.top_suppliers(wh).collect()]
    assert rows == [("BETA", D("370.00")), ("BETA", D("300.00")), ("ACME LTD", D("200.00"))]


def test_top_suppliers_monthly(wh):
    rows = sorted(tuple(r) for r in reports.top_suppliers_monthly(wh).collect())
    assert rows == [(2013, 1, "ACME LTD", D("200.00")), (2013, 2, "BETA", D("70.00")),
                    (2013, 4, "BETA", D("600.00"))]


def test_procedure_result_sets(wh):
    sets = reports.top_suppliers_result_sets(wh)
    assert [r.SupplierName for r in sets["overall"].collect()] == ["BETA", "BETA", "ACME LTD"]
    assert [(r.Year, r.Month) for r in sets["monthly"].collect()] == [(2013, 1), (2013, 2), (2013, 4)]


def test_expense_types_above_avg(wh):
    rows = sorted(tuple(r) for r in reports.expense_types_above_avg(wh).collect())
    assert rows == [("Rent", D("312.00"), D("208.116667")),
                    ("Travel", D("300.00"), D("208.116667"))]
    doc = reports.expense_types_above_avg_json(wh).collect()
    assert len(doc) == 1
    parsed = json.loads(doc[0].json)
    assert [i["ExpenseType"] for i in parsed["ExpenseTypesAboveAverage"]] == ["Rent", "Travel"]
    assert parsed["ExpenseTypesAboveAverage"][0]["TwoMonthTotal"] == 312.0


def test_expense_types_window_is_relative_to_last_fact_date(wh):
    # one month back from 30 April is 30 March: only April spend counts
    rows = sorted(tuple(r)[:2] for r in reports.expense_types_above_avg(wh, months=1).collect())
    assert rows == [("Rent", D("300.00")), ("Travel", D("300.00"))]
    # same answer without the observed latest date (a reopened warehouse scans for it)
    from spendstar.plans.warehouse import Warehouse
    bare = Warehouse(clean=wh.clean, dims=wh.dims, fact=wh.fact)
    assert sorted(map(tuple, reports.expense_types_above_avg(bare).collect())) == \
        sorted(map(tuple, reports.expense_types_above_avg(wh).collect()))


def test_area_rank_movement(wh):
    rows = sorted(tuple(r) for r in reports.area_rank_movement(wh).collect())
    assert rows == sorted([
        ("North", 2013, 1, D("200.00"), 1, None, None, 20130101),
        ("South", 2013, 2, D("70.00"), 1, None, None, 20130201),
        ("South", 2013, 3, D("12.00"), 1, 1, 0, 20130301),
        ("North", 2013, 4, D("300.00"), 1, 1, 0, 20130401),
        ("South", 2013, 4, D("300.00"), 1, 1, 0, 20130401),
        ("East", 2013, 4, D("12.35"), 3, None, None, 20130403),
    ])


def test_supplier_time_hierarchy(wh):
    rows = sorted((r.SupplierName, r.Year, r.Quarter, r.Month, r.MonthLabel, r.MonthlyTotal,
                   r.SupplierYearToDate, r.QuarterTotalAllSuppliers,
                   r.MonthlyShareOfQuarterPercent)
                  for r in reports.supplier_time_hierarchy(wh).collect())
    assert rows == [
        ("ACME LTD", 2013, 1, 1, "January 2013", D("200.00"), D("200.00"), D("282.00"),
         D("70.921986")),
        ("ACME LTD", 2013, 1, 3, "March 2013", None, D("200.00"), D("282.00"), None),
        ("BETA", 2013, 1, 2, "February 2013", D("70.00"), D("70.00"), D("282.00"),
         D("24.822695")),
        ("BETA", 2013, 2, 4, "April 2013", D("600.00"), D("670.00"), D("612.35"),
         D("97.983180")),
        ("GAMMA", 2013, 2, 4, "April 2013", D("12.35"), D("12.35"), D("612.35"),
         D("2.016820")),
        ("REDACTED_PERSONAL_EXPENSE", 2013, 1, 3, "March 2013", D("12.00"), D("12.00"),
         D("282.00"), D("4.255319")),
    ]


def test_dataframe_input_gives_same_warehouse(spark, wh):
    # Straight from a DataFrame (blank postcodes stay blank instead of NULL):
    # the star schema is the same.
    direct = build_warehouse(toy.staging(spark), toy.rejects(spark))
    for name in wh.dims:
        assert sorted(map(tuple, direct.dims[name].collect())) == \
            sorted(map(tuple, wh.dims[name].collect()))
    assert sorted(map(tuple, direct.numbered_fact.collect())) == \
        sorted(map(tuple, wh.numbered_fact.collect()))
