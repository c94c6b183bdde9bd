"""What the counters, the sample check and the case-insensitive load move."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spendstar.operators.audit import stage_counters
from spendstar.plans import catalog
from spendstar.sources import tables
from spendstar.sources.tpch_adapter import rejects_from_tpch, spend_from_tpch
from test_reject_lists import _tables


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_counters_read_staging_once_and_only_the_natural_key(spark, tmp_path):
    at = str(tmp_path)
    _tables(spark, at)
    counters = stage_counters(spend_from_tpch(spark, at), rejects_from_tpch(spark, at))
    plan = _optimized(counters)
    assert plan.count("Join Inner, (l_orderkey") == 1
    relations = [line for line in plan.splitlines() if "Relation" not in line]
    assert all(c not in line for line in relations for c in ("p_name", "o_orderpriority", "r_name", "l_linestatus"))


def test_counters_of_no_rows_are_zero(spark):
    staging = catalog.SPEND_COLUMNS
    none = spark.createDataFrame([], ", ".join(f"{c} string" for c in staging))
    rejects = spark.createDataFrame([("a",), ("a",), (None,)], "SupplierName string")
    got = {r.metric: r.value for r in stage_counters(none, rejects).collect()}
    assert got.pop("InvalidSupplierCount") == 3 and len(got) == 8 and set(got.values()) == {0}


def test_the_sample_is_sent_to_the_staged_rows(spark, tmp_path):
    at = str(tmp_path)
    _tables(spark, at)
    checked = catalog._staging_sample_check(spark, at)
    semi = [line for line in _optimized(checked).splitlines() if "Join LeftSemi" in line]
    assert len(semi) == 2 and all("strategy=broadcast" in line for line in semi)
    assert [tuple(r) for r in checked.collect()] == [(44, 44)]


def test_upper_case_copies_join_staging_once(spark, tmp_path, monkeypatch):
    at, seen = str(tmp_path), []
    _tables(spark, at)

    class Stop(Exception):
        pass

    def stop(staging, *args, **kwargs):
        seen.append(staging)
        raise Stop
    monkeypatch.setattr(catalog, "build_warehouse", stop)
    # transaction numbers that end in 5 are copied
    monkeypatch.setattr(catalog, "spend_from_tpch", lambda s, d: spend_from_tpch(s, d).withColumn(
        "TransactionNumber", F.when(F.col("ContractNumber") == "9", F.lit(None).cast("string"))
        .otherwise(F.col("ContractNumber"))))
    with pytest.raises(Stop):
        catalog._case_insensitive(spark, at)
    assert "Union" not in _optimized(seen[0])
    names = [(r.TransactionNumber, r.Supplier) for r in seen[0].collect()]
    assert len(names) == 44 + 4  # 5, 15, 25 and 35
    assert sorted(n for n in names if n[0] in ("5", "9")) == [("5", "S12"), ("5", "S12")]


def test_small_lookups_are_broadcast_whatever_the_threshold(spark, tmp_path, monkeypatch):
    at, name = str(tmp_path), "spark.sql.autoBroadcastJoinThreshold"
    _tables(spark, at)
    old = spark.conf.get(name)

    def joins():
        steps = catalog.steps_for(spark, at)
        plan = steps.rejected._jdf.queryExecution().executedPlan().toString()
        return plan.count("BroadcastHashJoin"), plan.count("SortMergeJoin")
    try:
        spark.conf.set(name, "1")
        assert joins() == (5, 1)  # the orders are the planner's
        spark.conf.set(name, "-1")
        assert joins() == (0, 6)
        spark.conf.set(name, "1")
        monkeypatch.setattr(tables, "LOOKUP_BYTES", 0)
        assert joins() == (0, 6)
    finally:
        spark.conf.set(name, old)
