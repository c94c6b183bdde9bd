"""Invariants of the warehouse built from the driver's smallest tables."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from spendstar.operators.audit import integrity
from spendstar.operators.dimensions import DIMENSIONS
from spendstar.operators.fact import unmatched
from spendstar.plans import reports
from spendstar.plans.catalog import warehouse_for
from spendstar.plans.warehouse import build_warehouse
from spendstar.sources.tpch_adapter import rejects_from_tpch, spend_from_tpch


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse_for(spark, SF_SMALL)


def test_keys_dense_unique_and_in_attribute_order(wh):
    for name, (key, cols) in DIMENSIONS.items():
        dim = wh.dims[name]
        n = dim.count()
        stats = dim.agg(F.min(key), F.max(key), F.count_distinct(key)).first()
        assert tuple(stats) == (1, n, n), name
        # unique on the natural attributes (NULLs equal)
        assert dim.select(*cols).distinct().count() == n, name
        ordered = [tuple(r) for r in dim.orderBy(
            *[F.col(c).asc_nulls_first() for c in cols]).select(key).collect()]
        assert [k for (k,) in ordered] == list(range(1, n + 1)), name
    dates = [r.FullDate for r in wh.dim_date.orderBy("DateID").collect()]
    assert dates == sorted(dates)


def test_integrity_is_clean(wh):
    bad = [r for r in integrity(wh.dims, wh.numbered_fact).collect() if r.violations != 0]
    assert bad == []


def test_clean_equals_fact_plus_losses(wh):
    clean = wh.clean.count()
    fact = wh.fact.count()
    lost = {r.dimension: r.unmatched_rows for r in unmatched(wh.clean, wh.dims).collect()}
    assert fact <= clean - max(lost.values())
    assert clean - fact <= sum(lost.values())


def test_rank_one_in_every_month(wh):
    r = reports.area_rank_movement(wh)
    months = r.select("Year", "Month").distinct().count()
    assert r.where(F.col("RankNow") == 1).select("Year", "Month").distinct().count() == months
    assert r.where(F.col("RankNow") > 10).count() == 0


def test_ytd_of_last_month_is_year_total_and_shares_sum_to_100(wh):
    q5 = reports.supplier_time_hierarchy(wh)
    last = Window.partitionBy("SupplierName", "Year").orderBy(F.col("Month").desc())
    tail = q5.withColumn("_rn", F.row_number().over(last)).where("_rn = 1")
    totals = q5.groupBy("SupplierName", "Year").agg(F.sum("MonthlyTotal").alias("t"))
    mism = tail.join(totals, ["SupplierName", "Year"]).where(
        F.coalesce(F.col("SupplierYearToDate"), F.lit(0)) != F.coalesce(F.col("t"), F.lit(0)))
    assert mism.count() == 0
    shares = q5.groupBy("Year", "Quarter").agg(F.sum("MonthlyShareOfQuarterPercent").alias("s"))
    for r in shares.collect():
        assert abs(r.s - D(100)) < D("0.001"), r


def test_result_does_not_depend_on_input_partitioning(spark, wh):
    staging = spend_from_tpch(spark, SF_SMALL).repartition(13, "Supplier")
    other = build_warehouse(staging, rejects_from_tpch(spark, SF_SMALL).repartition(3))
    for name in wh.dims:
        assert sorted(map(tuple, other.dims[name].collect())) == \
            sorted(map(tuple, wh.dims[name].collect())), name
    assert sorted(map(tuple, other.numbered_fact.collect())) == \
        sorted(map(tuple, wh.numbered_fact.collect()))
    assert sorted(map(tuple, reports.area_rank_movement(other).collect())) == \
        sorted(map(tuple, reports.area_rank_movement(wh).collect()))
