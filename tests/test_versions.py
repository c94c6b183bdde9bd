"""A rebuild is one switch: readers see the old load or the new one, whole."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
import toy
from pyspark.sql import functions as F

from conftest import ROOT
from spendstar.plans import reports
from spendstar.plans.warehouse import build_warehouse, open_warehouse
from spendstar.sources import versions

# Dies after the dimensions are written and before the fact is.
KILLED = """
import os, sys
sys.path[:0] = [{root!r}, {tests!r}]
import toy
from spendstar.session import local_session
from spendstar.plans import warehouse
spark = local_session(cores="2", shuffle_partitions=2, app="killed", driver_memory="1g")
def die(*args, **kwargs):
    print("dimensions written", flush=True)
    os._exit(9)
warehouse.load_fact = die
warehouse.build_warehouse(toy.staging(spark).limit(3), toy.rejects(spark), path={path!r})
"""


def _rows(df):
    return sorted(map(repr, df.collect()))


def _load(spark, path, staging):
    return build_warehouse(staging, toy.rejects(spark), path=path)


def test_a_killed_load_leaves_the_old_warehouse_whole(spark, tmp_path):
    path = str(tmp_path / "wh")
    _load(spark, path, toy.staging(spark))
    before = {n: _rows(t) for n, t in open_warehouse(spark, path).tables().items()}
    code = KILLED.format(root=ROOT, tests=os.path.join(ROOT, "tests"), path=path)
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert run.returncode == 9 and "dimensions written" in run.stdout
    assert len(versions.versions(spark, path)) == 2  # the dead load's folder is there, unused
    after = open_warehouse(spark, path)
    assert {n: _rows(t) for n, t in after.tables().items()} == before
    assert after.counters["FactRows"] == after.fact.count() == 9
    assert reports.top_suppliers(after).count() == 3


def test_an_open_warehouse_outlives_a_rebuild(spark, tmp_path):
    path = str(tmp_path / "wh")
    _load(spark, path, toy.staging(spark))
    held = open_warehouse(spark, path)
    old = {n: _rows(t) for n, t in held.tables().items()}
    later = toy.staging(spark).where("TransactionNumber IS NOT NULL").withColumn(
        "Supplier", F.concat(F.lit("New "), "Supplier"))
    new = _load(spark, path, later)
    assert {n: _rows(t) for n, t in held.tables().items()} == old
    now = open_warehouse(spark, path)
    assert now.version == new.version != held.version
    assert {n: _rows(t) for n, t in now.tables().items()} == \
        {n: _rows(t) for n, t in new.tables().items()}
    earlier = open_warehouse(spark, path, version=held.version)
    assert _rows(earlier.numbered_fact) == old["FactInvoice"]


def test_expire_keeps_the_current_load(spark, tmp_path):
    path = str(tmp_path / "wh")
    names = [_load(spark, path, toy.staging(spark)).version for _ in range(3)]
    assert versions.versions(spark, path) == sorted(names)
    assert versions.expire(spark, path, keep=2) == sorted(names)[:1]
    assert versions.expire(spark, path, keep=1) == sorted(names)[1:2]
    assert open_warehouse(spark, path).fact.count() == 9


def test_no_load_and_a_lost_table_are_errors(spark, tmp_path):
    with pytest.raises(versions.NoWarehouseError):
        open_warehouse(spark, str(tmp_path / "nothing"))
    path = str(tmp_path / "wh")
    wh = _load(spark, path, toy.staging(spark))
    folder = versions.version_path(path, wh.version)
    os.rename(f"{folder}/DimSupplier", f"{folder}/elsewhere")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        open_warehouse(spark, path)
    assert os.path.isdir(f"{folder}/DimDate") and os.path.isdir(f"{folder}/FactInvoice")


def test_an_empty_load_has_every_table(spark, tmp_path):
    path = str(tmp_path / "wh")
    _load(spark, path, toy.staging(spark).limit(0))
    wh = open_warehouse(spark, path)
    assert all(t.count() == 0 for t in wh.tables().values()) and wh.counters["FactRows"] == 0
