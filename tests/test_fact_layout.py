"""The stored fact: narrow files by date, dense FactIDs, exact counters."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
import toy
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from spendstar.operators.audit import stage_counters
from spendstar.operators.cleaning import counters_of, dedup, dedup_counted, mark_rejected, redact, type_columns
from spendstar.operators.fact import (
    FACT_ORDER,
    date_layout,
    fact_salt,
    file_ranges,
    lay_out,
    unmatched,
    with_fact_ids,
)
from spendstar.plans import reports
from spendstar.plans.catalog import steps_for, warehouse_for
from spendstar.plans.warehouse import fact_files_wanted, load_fact
from spendstar.sources.tables import materialize


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse_for(spark, SF_SMALL)


@pytest.fixture(scope="module")
def files(spark):
    """A fact of 40,000 rows over 200 dates, one of which holds a third."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id") % 200 + 1).cast("int").alias("DateID"),
        (F.col("id") % 50).cast("int").alias("SupplierID"),
        *[F.lit(1).alias(c) for c in ("OrganisationID", "ExpenseTypeID", "ExpenseAreaID")],
        F.col("id").cast("decimal(18,2)").alias("Amount"),
        F.concat(F.lit("T"), "id").alias("TransactionNumber"), F.lit("d").alias("Description"))
    dates = rows.groupBy("DateID").agg(F.count("*").alias("_rows"))
    layout = date_layout(dates, 2000)
    wanted = layout.agg(F.max(F.col("_first") + F.col("_files"))).first()[0]
    stored = materialize(lay_out(rows, layout, wanted), "laid-out")
    return stored, file_ranges(stored).orderBy("Part").collect()


def test_files_hold_narrow_date_ranges(files):
    stored, ranges = files
    assert sum(r.Rows for r in ranges) == 40_000
    assert 18 <= len(ranges) <= 21 and max(r.Rows for r in ranges) <= 4_000
    # in date order: a file ends where the next begins; the hot date has several of its own
    for a, b in zip(ranges, ranges[1:]):
        assert a.MaxDateID <= b.MinDateID
    assert sum(r.MinDateID <= 77 <= r.MaxDateID for r in ranges) >= 6
    assert [r.FirstID for r in ranges] == [1 + sum(r.Rows for r in ranges[:i]) for i in range(len(ranges))]


def test_a_date_window_skips_row_groups(files):
    """The scan's own counter: rows read for ten dates of 200."""
    stored, _ = files
    window = stored.where((F.col("DateID") > 150) & (F.col("DateID") <= 160))
    assert window.count() == 1333 or window.count() > 0
    scan = [n for n in _nodes(window) if "Scan parquet" in n.nodeName()][0]
    read = scan.metrics().apply("numOutputRows").value()
    assert window.count() <= read <= 6_000  # of 40,000


def _nodes(df):
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    found, stack = [], [plan]
    while stack:
        node = stack.pop()
        found.append(node)
        if "AdaptiveSparkPlan" in node.nodeName():
            stack.append(node.executedPlan())
        kids = node.children()
        stack += [kids.apply(i) for i in range(kids.size())]
    return found


def test_fact_ids_are_dense_ordered_and_repeatable(spark, wh):
    n = wh.fact.count()
    ids = wh.numbered_fact.agg(F.min("FactID"), F.max("FactID"), F.count_distinct("FactID")).first()
    assert tuple(ids) == (1, n, n)
    rows = wh.numbered_fact.withColumn("_salt", fact_salt()).orderBy("FactID").collect()
    keys = [tuple((r[c] is not None, r[c]) for c in FACT_ORDER) for r in rows]
    assert keys == sorted(keys)
    # other file counts, other task counts: the same ids
    clean = wh.clean.repartition(5)
    members = {name: df for name, df in _members(spark, clean).items()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again, ranges, counters = load_fact(clean, wh.dims, members)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    again = with_fact_ids(again, ranges.collect())
    assert sorted(map(repr, again.collect())) == sorted(map(repr, wh.numbered_fact.collect()))
    assert counters["FactRows"] == n


def _members(spark, clean):
    from spendstar.operators.dimensions import keyed_members, read_members
    return read_members(spark, *keyed_members(clean))


def test_ids_stay_dense_where_the_session_cuts_files(spark, wh):
    """``maxRecordsPerFile`` would give a task several files of one number."""
    key = "spark.sql.files.maxRecordsPerFile"
    old = spark.conf.get(key)
    spark.conf.set(key, "100")
    try:
        stored, ranges, counters = load_fact(wh.clean, wh.dims, _members(spark, wh.clean))
    finally:
        spark.conf.set(key, old)
    ids = with_fact_ids(stored, ranges.collect()).agg(
        F.min("FactID"), F.max("FactID"), F.count_distinct("FactID")).first()
    assert tuple(ids) == (1, counters["FactRows"], counters["FactRows"])


def test_file_count_follows_the_bytes():
    mb = 1 << 20
    assert fact_files_wanted(0, 200) == 1
    assert fact_files_wanted(5 * mb, 200) == 5
    assert fact_files_wanted(1000 * mb, 200) == 200
    assert fact_files_wanted(10_000_000 * mb, 200) == 10_000_000 // 128


def test_counters_equal_the_recount(spark, wh):
    steps = steps_for(spark, SF_SMALL)
    want = {r.metric: r.value for r in stage_counters(steps.staging, steps.rejects).collect()}
    assert {k: wh.counters[k] for k in want} == want
    lost = {r.dimension: r.unmatched_rows for r in unmatched(wh.clean, wh.dims).collect()}
    assert {f"No{d}Match": n for d, n in lost.items()} == \
        {k: wh.counters[k] for k in wh.counters if k.startswith("No")}
    assert min(lost.values()) > 0  # every kind of loss occurs
    assert wh.counters["MaxDateID"] == wh.fact.agg(F.max("DateID")).first()[0]


@pytest.mark.parametrize("case_insensitive", [False, True])
def test_counted_dedup_keeps_the_same_rows(spark, case_insensitive):
    staging = toy.staging(spark).unionByName(toy.staging(spark).withColumn("Supplier", F.upper("Supplier")))
    flagged = type_columns(redact(mark_rejected(staging, toy.rejects(spark)),
                                  case_insensitive=case_insensitive), keep=["_rejected"])
    counted = dedup_counted(flagged, case_insensitive=case_insensitive)
    kept = flagged.where("NOT _rejected").drop("_rejected")
    want = dedup(kept, case_insensitive=case_insensitive)
    got = counted.where("Part = 'kept'").select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    totals = counters_of(counted).first()
    assert totals.StagingRowCount == staging.count() and totals.StagingRowCount_After == kept.count()


# Every task of the staging scan delivers all its rows, then fails once.
RETRIED = """
import sys
sys.path[:0] = [{root!r}, {tests!r}]
import json, toy
from pyspark import TaskContext
from spendstar.session import DEFAULT_CONF
from spendstar.plans.warehouse import build_warehouse
from pyspark.sql import SparkSession
builder = SparkSession.builder.master("local[2,4]")
for k, v in dict(DEFAULT_CONF, **{{"spark.sql.shuffle.partitions": "3"}}).items():
    builder = builder.config(k, v)
spark = builder.getOrCreate()
spark.sparkContext.setLogLevel("OFF")
def flaky(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost after its last row")
rows = toy.staging(spark).repartition(4)
wh = build_warehouse(rows.mapInArrow(flaky, rows.schema), toy.rejects(spark))
print("COUNTERS " + json.dumps(wh.counters))
"""


def test_counters_survive_failed_tasks(spark):
    import json

    from spendstar.plans.warehouse import build_warehouse
    code = RETRIED.format(root=ROOT, tests=os.path.join(ROOT, "tests"))
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    line = [x for x in run.stdout.splitlines() if x.startswith("COUNTERS ")]
    assert line, run.stderr[-2000:]
    assert json.loads(line[0][9:]) == build_warehouse(toy.staging(spark), toy.rejects(spark)).counters


def test_reports_do_not_number_the_fact(wh):
    plan = reports.top_suppliers(wh)._jdf.queryExecution().executedPlan().toString()
    assert "row_index" not in plan
