"""Runs that used to lose or double rows without an error."""

from __future__ import annotations

import pytest
import toy
from pyspark.sql import functions as F

from spendstar.constants import SPEND_COLUMNS
from spendstar.plans.warehouse import build_warehouse, open_warehouse
from spendstar.sources.reject_list import RejectListError, read_reject_list
from spendstar.streaming import ingest_spend


def test_default_stream_checkpoint_belongs_to_the_table(spark, tmp_path):
    """A later application has another checkpoint folder; new files still arrive."""
    inbox, staging = tmp_path / "inbox", str(tmp_path / "staging")
    inbox.mkdir()
    before = spark.sparkContext.getCheckpointDir()
    try:
        for n, entity in enumerate(["E1", "E2"]):
            row = "\t".join(["D", entity, "01/02/2013"] + [""] * (len(SPEND_COLUMNS) - 3))
            (inbox / f"{entity}.txt").write_text("\t".join(SPEND_COLUMNS) + "\n" + row + "\n")
            spark.sparkContext.setCheckpointDir(str(tmp_path / f"application{n}"))
            ingest_spend(spark, str(inbox), staging).awaitTermination()
    finally:
        spark.sparkContext.setCheckpointDir(before)
    assert sorted(r.Entity for r in spark.read.parquet(staging).collect()) == ["E1", "E2"]


def test_rebuild_replaces_all_rows_in_dynamic_mode(spark, tmp_path):
    path, key = str(tmp_path / "wh"), "spark.sql.sources.partitionOverwriteMode"
    mode = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        build_warehouse(toy.staging(spark), toy.rejects(spark), path=path)
        later = toy.staging(spark).withColumn(
            "DateOfPayment", F.regexp_replace("DateOfPayment", "20[0-9]{2}", "2019"))
        rebuilt = build_warehouse(later, toy.rejects(spark), path=path)
        assert open_warehouse(spark, path).fact.count() == rebuilt.counters["FactRows"]
    finally:
        spark.conf.set(key, mode)


def test_nameless_supplier_stops_the_read(spark, tmp_path):
    path = tmp_path / "r.xml"
    path.write_text('<Suppliers><Supplier SupplierName="A"/><Supplier Other="B"/></Suppliers>')
    with pytest.raises(RejectListError, match="without SupplierName"):
        read_reject_list(spark, str(path))
