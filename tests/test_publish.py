"""Publishing: Parquet folders, catalog tables and the five report views."""

from __future__ import annotations

import pytest

import toy
from spendstar.plans import reports
from spendstar.plans.publish import (
    VIEW_NAMES,
    prepare_namespace,
    publish,
    register_views,
    save_tables,
    save_views,
    saved_tables,
)
from spendstar.plans.warehouse import build_warehouse, open_warehouse


@pytest.fixture(scope="module")
def wh(spark):
    return build_warehouse(toy.staging(spark), toy.rejects(spark))


def test_views(spark, wh):
    names = register_views(wh, prefix="toy_")
    assert names == ["toy_" + n for n in VIEW_NAMES]
    assert spark.sql("SELECT count(*) FROM toy_vw_Top3Suppliers").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM toy_FactInvoice").first()[0] == 9
    top = spark.sql("SELECT ExpenseArea FROM toy_vw_MonthlyExpenseAreaRanking "
                    "WHERE SortKey = 20130403").first()
    assert top.ExpenseArea == "East"


def test_catalog_tables(spark, wh):
    names = save_tables(wh, "spend_toy")
    assert names[-1] == "spend_toy.FactInvoice"
    assert spark.catalog.databaseExists("spend_toy")
    assert all(spark.catalog.tableExists(n) for n in names)
    assert spark.table("spend_toy.DimSupplier").count() == 7


def test_publish_manifest_and_reopen(spark, wh, tmp_path):
    rows = {r.table: r.rows for r in publish(wh, str(tmp_path / "pub")).collect()}
    assert rows["FactInvoice"] == 9 and rows["DimDate"] == 6


def test_build_into_folder_then_reopen(spark, tmp_path):
    path = str(tmp_path / "wh")
    built = build_warehouse(toy.staging(spark), toy.rejects(spark), path=path)
    again = open_warehouse(spark, path)
    assert again.fact.count() == built.fact.count() == 9
    assert again.counters == built.counters and again.counters["MaxDateID"] == 6
    assert sorted(map(tuple, again.dims["DimSupplier"].collect())) == \
        sorted(map(tuple, built.dims["DimSupplier"].collect()))


def test_views_belong_to_the_catalog(spark, wh):
    """Made in one session, read by name in another; no plan of a session is in them."""
    save_tables(wh, "spend_views")
    names = save_views(spark, "spend_views")
    assert names == [f"spend_views.{n}" for n in VIEW_NAMES]
    other = spark.newSession()
    for name, report in VIEW_NAMES.items():
        view = other.table(f"spend_views.{name}")
        direct = report(wh)
        assert view.columns == direct.columns and view.dtypes == direct.dtypes, name
        assert sorted(map(repr, view.collect())) == sorted(map(repr, direct.collect())), name
        text = spark.sql(f"SHOW CREATE TABLE spend_views.{name}").first()[0]
        assert "spend_views" in text


def test_the_date_window_of_a_view_follows_the_fact(spark, wh):
    save_tables(wh, "spend_window")
    save_views(spark, "spend_window")
    view = "spend_window.vw_ExpenseTypeAboveAvg2Month"
    before = spark.table(view).collect()
    days = wh.dim_date.orderBy("FullDate").collect()
    early = build_warehouse(toy.staging(spark).where(
        f"try_to_date(trim(DateOfPayment), 'd/M/yyyy') <= DATE'{days[1].FullDate}'"), toy.rejects(spark))
    save_tables(early, "spend_window")  # the tables change, the views stay
    after = sorted(map(repr, spark.table(view).collect()))
    assert after == sorted(map(repr, reports.expense_types_above_avg(early).collect()))
    assert after != sorted(map(repr, before))


def test_a_namespace_is_reset_and_rebuilt(spark, wh):
    first = prepare_namespace(spark, "spend_reset").first()
    assert (first.existed, first.current) == (False, spark.catalog.currentDatabase())
    spark.sql("CREATE TABLE spend_reset.Leftover (x INT) USING parquet")
    assert prepare_namespace(spark, "spend_reset").first().existed
    assert [r.table for r in saved_tables(spark, "spend_reset").collect()] == ["leftover"]
    assert prepare_namespace(spark, "spend_reset", reset=True).first().existed
    assert saved_tables(spark, "spend_reset").count() == 0
    for _ in range(2):  # a table that exists is dropped and built anew
        save_tables(wh, "spend_reset")
    assert {r.table: r.rows for r in saved_tables(spark, "spend_reset").collect()}["factinvoice"] == 9


def test_the_saved_fact_has_its_ids(spark, wh):
    save_tables(wh, "spend_ids")
    ids = sorted(r.FactID for r in spark.table("spend_ids.FactInvoice").collect())
    assert ids == list(range(1, 10))
