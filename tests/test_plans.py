"""Plan checks: the physical plans we rely on at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from spendstar.plans import reports
from spendstar.plans.catalog import steps_for, warehouse_for
from spendstar.operators.audit import duplicate_ids
from spendstar.operators.cleaning import REJECTED_FLAG, mark_rejected
from spendstar.operators.fact import star_join


def _plan(df) -> str:
    # formatted plan text, as a user would read it from explain()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse_for(spark, SF_SMALL)


REPORTS = [reports.top_suppliers, reports.top_suppliers_monthly,
           reports.expense_types_above_avg, reports.expense_types_above_avg_json,
           reports.area_rank_movement, reports.supplier_time_hierarchy]


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :|+-"))


def _single_partition_consumers(plan: str) -> list[str]:
    """The operator fed by each ``Exchange SinglePartition`` (stage wrappers skipped).

    A window or sort fed by a single partition gathers every row into one
    task; only a global aggregate (one row out) may sit on one.
    """
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        depth = _indent(line)
        for prev in reversed(lines[:i]):
            if _indent(prev) < depth:
                depth = _indent(prev)
                if not re.search(r"ShuffleQueryStage|AQEShuffleRead|InputAdapter", prev):
                    out.append(re.sub(r"^[\s:|+\-]*(\*\(\d+\) )?", "", prev))
                    break
    return out


def _unpartitioned_windows(plan: str) -> list[str]:
    return [op for op in _single_partition_consumers(plan)
            if op.startswith(("Window", "Sort", "WindowGroupLimit"))]


def test_the_window_check_catches_a_bare_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    df.collect()
    assert _unpartitioned_windows(_plan(df))


@pytest.mark.parametrize("fn", REPORTS, ids=lambda f: f.__name__)
def test_no_cartesian_product_and_no_unpartitioned_window(wh, fn):
    df = fn(wh)
    df.collect()
    plan = _plan(df)
    assert "CartesianProduct" not in plan
    assert _unpartitioned_windows(plan) == []
    # only global aggregates (one row out) may read a single partition; the
    # JSON report's collect_list holds one entry per expense type
    assert all(op.startswith(("HashAggregate", "ObjectHashAggregate"))
               for op in _single_partition_consumers(plan))


def test_date_window_is_pushed_to_the_fact_scan(wh):
    df = reports.expense_types_above_avg(wh)
    df.collect()
    plan = _plan(df)
    assert "GreaterThan(DateID," in plan and "LessThanOrEqual(DateID," in plan


def test_fact_load_broadcasts_small_dimensions(wh):
    plan = _plan(star_join(wh.clean, wh.dims))
    assert plan.count("BroadcastHashJoin") == 5
    assert "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_rows_with_a_null_key_leave_before_the_joins(spark, wh):
    """Where no dimension can be broadcast, such rows are not even shuffled."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(star_join(wh.clean, wh.dims))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 5 and "LeftOuter" not in plan
    below = plan.split("SortMergeJoin")[5]  # the clean side of the innermost join
    filters = [line for line in below.splitlines() if "Filter" in line]
    assert any(all(f"isnotnull({c}" in line or f"isnotnull(nullif(trim({c}" in line or c in line
                   for c in ("Department", "Entity", "Supplier", "ExpenseType", "ExpenseArea",
                             "DateOfPayment")) for line in filters)


def test_null_suppliers_are_dealt_to_all_tasks(spark):
    """A third of all rows has no supplier and the reject list is not broadcast."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("S"), "id"))
                                    .alias("Supplier"), "id")
    rejects = spark.createDataFrame([("S1",), ("S2",), ("",)], "SupplierName string")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": "20"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        marked = mark_rejected(rows, rejects)
        assert "SortMergeJoin" in _plan(marked)
        per_task = (marked.where("Supplier IS NULL").groupBy(F.spark_partition_id(), REJECTED_FLAG)
                    .count().collect())
        assert len(per_task) == 20 and max(r["count"] for r in per_task) < 150
        assert sorted(r.Supplier for r in marked.where(REJECTED_FLAG).collect()) == ["S1", "S2"]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_the_fact_is_dealt_without_sampling_and_numbered_without_shuffle(wh):
    stored = _plan(wh.numbered_fact.select("FactID", "Amount"))
    assert "Exchange" not in stored and "Window" not in stored


def test_unique_fact_ids_are_proven_without_shuffling_them(wh):
    plan = _plan(duplicate_ids(wh.numbered_fact, "FactID"))
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and all("FactID" not in line for line in exchanges)
    assert "bitmap_construct_agg" in plan


def test_dedup_is_one_shuffle_with_map_side_limit(spark):
    deduped = steps_for(spark, SF_SMALL).deduped
    deduped.write.format("noop").mode("overwrite").save()
    plan = _plan(deduped)
    assert plan.count("WindowGroupLimit") >= 2


def test_top_k_uses_take_ordered(wh):
    df = reports.top_suppliers(wh)
    df.collect()
    assert "TakeOrderedAndProject" in _plan(df)
