"""The paths a large cluster takes: no broadcast of dimensions, hot keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import toy
from conftest import SF_SMALL
from spendstar.constants import SPEND_COLUMNS
from spendstar.operators.fact import build_fact
from spendstar.plans import reports
from spendstar.plans.catalog import warehouse_for
from spendstar.plans.warehouse import build_warehouse
from spendstar.sources.tpch_adapter import rejects_from_tpch, spend_from_tpch


@pytest.fixture
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_shuffle_join_path_gives_the_same_warehouse(spark, no_auto_broadcast):
    small = warehouse_for(spark, SF_SMALL)  # built with broadcasts earlier or now
    big = build_warehouse(spend_from_tpch(spark, SF_SMALL), rejects_from_tpch(spark, SF_SMALL))
    plan = build_fact(big.clean, big.dims)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    for name in small.dims:
        assert _rows(big.dims[name]) == _rows(small.dims[name]), name
    assert _rows(big.numbered_fact) == _rows(small.numbered_fact)
    for fn in (reports.top_suppliers, reports.top_suppliers_monthly,
               reports.expense_types_above_avg, reports.area_rank_movement,
               reports.supplier_time_hierarchy):
        assert _rows(fn(big)) == _rows(fn(small)), fn.__name__


def test_hot_supplier_third_of_rows(spark):
    base = toy.staging(spark)
    # one supplier holds a third of all rows, half of them copies of one payment
    hot = spark.range(0, 600).select(
        *[F.lit(v).alias(c) for c, v in zip(
            SPEND_COLUMNS[:6], ["BIS", "HQ", "01/04/2013", "Misc", "East", "HOT LTD"])],
        F.when(F.col("id") % 2 == 0, F.lit("H0")).otherwise(
            F.concat(F.lit("H"), F.col("id").cast("string"))).alias("TransactionNumber"),
        F.lit("1.00").alias("Amount"),
        *[F.lit(None).cast("string").alias(c) for c in SPEND_COLUMNS[8:10]],
        F.lit("SME").alias("SupplierType"),
        *[F.lit(None).cast("string").alias(c) for c in SPEND_COLUMNS[11:]])
    filler = spark.range(0, 1200).select(
        *[F.lit(v).alias(c) for c, v in zip(
            SPEND_COLUMNS[:6], ["BIS", "HQ", "02/04/2013", "Misc", "West", "OTHER"])],
        F.concat(F.lit("O"), F.col("id").cast("string")).alias("TransactionNumber"),
        F.lit("2.00").alias("Amount"),
        *[F.lit(None).cast("string").alias(c) for c in SPEND_COLUMNS[8:10]],
        F.lit("SME").alias("SupplierType"),
        *[F.lit(None).cast("string").alias(c) for c in SPEND_COLUMNS[11:]])
    staging = base.unionByName(hot).unionByName(filler).repartition(8)
    wh = build_warehouse(staging, toy.rejects(spark))
    # 300 copies of H0 collapse to one; 300 distinct H-odd payments stay
    assert wh.fact.join(wh.dim_supplier.where("SupplierName = 'HOT LTD'"),
                        "SupplierID").count() == 301
    top = {r.SupplierName: r.TotalSpent for r in reports.top_suppliers(wh).collect()}
    assert top["OTHER"] == 2400 and top["HOT LTD"] == 301


def test_many_shuffle_partitions_give_the_same_keys(spark):
    small = warehouse_for(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        wide = build_warehouse(spend_from_tpch(spark, SF_SMALL),
                               rejects_from_tpch(spark, SF_SMALL))
        for name in small.dims:
            assert _rows(wide.dims[name]) == _rows(small.dims[name]), name
        assert _rows(wide.numbered_fact) == _rows(small.numbered_fact)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_empty_input_gives_an_empty_warehouse(spark):
    wh = build_warehouse(toy.staging(spark).limit(0), toy.rejects(spark))
    assert wh.counters["StagingRowCount"] == 0 and wh.counters["MaxDateID"] is None
    assert all(d.count() == 0 for d in wh.dims.values()) and wh.fact.count() == 0
    for fn in (reports.top_suppliers, reports.top_suppliers_monthly,
               reports.expense_types_above_avg, reports.expense_types_above_avg_json,
               reports.area_rank_movement, reports.supplier_time_hierarchy):
        assert fn(wh).count() == 0, fn.__name__
