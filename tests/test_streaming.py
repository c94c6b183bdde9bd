"""Incremental staging load: each arriving file is appended exactly once."""

from __future__ import annotations

import pytest

from spendstar.constants import SPEND_COLUMNS
from spendstar.streaming import ingest_spend

HEADER = "\t".join(SPEND_COLUMNS)


def _file(folder, name, entities):
    body = "".join("\t".join(["D", e, "01/02/2013"] + [""] * (len(SPEND_COLUMNS) - 3)) + "\n"
                   for e in entities)
    (folder / name).write_text(HEADER + "\n" + body)


def test_files_are_appended_once(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    staging = str(tmp_path / "staging")
    ckpt = str(tmp_path / "ckpt")
    _file(inbox, "a.txt", ["E1", "E2"])
    _file(inbox, "b.txt", ["E3"])
    ingest_spend(spark, str(inbox), staging, checkpoint=ckpt).awaitTermination()
    assert spark.read.parquet(staging).count() == 3
    # a rerun with nothing new appends nothing
    ingest_spend(spark, str(inbox), staging, checkpoint=ckpt).awaitTermination()
    assert spark.read.parquet(staging).count() == 3
    _file(inbox, "c.txt", ["E4", "E5"])
    ingest_spend(spark, str(inbox), staging, checkpoint=ckpt).awaitTermination()
    rows = spark.read.parquet(staging).collect()
    assert sorted(r.Entity for r in rows) == ["E1", "E2", "E3", "E4", "E5"]
    assert {r.source_file.rsplit("/", 1)[-1] for r in rows} == {"a.txt", "b.txt", "c.txt"}


def test_streamed_staging_feeds_the_warehouse(spark, tmp_path):
    import toy
    from spendstar.plans import reports
    from spendstar.plans.warehouse import build_warehouse
    from spendstar.sources.delimited import write_spend

    inbox = tmp_path / "inbox"
    write_spend(toy.staging(spark).coalesce(2), str(inbox))  # two files arrive
    staging = str(tmp_path / "staging")
    ingest_spend(spark, str(inbox), staging, checkpoint=str(tmp_path / "ckpt")).awaitTermination()
    rows = spark.read.parquet(staging).drop("_corrupt_record", "source_file")
    wh = build_warehouse(rows, toy.rejects(spark))
    top = [tuple(r) for r in reports.top_suppliers(wh).collect()]
    assert [name for name, _ in top] == ["BETA", "BETA", "ACME LTD"]
    assert wh.counters["StagingRowCount"] == 14 and wh.counters["FactRows"] == 9


def test_a_stream_reads_one_kind_of_file(spark, tmp_path):
    header, row = "\t".join(SPEND_COLUMNS), "\t".join(["Dé", "a\rb"] + [""] * (len(SPEND_COLUMNS) - 2))
    body = "".join(x + "\r\n" for x in (header, row))
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.txt").write_bytes(b"\xfe\xff" + body.encode("UTF-16BE"))
    out = str(tmp_path / "out")
    ingest_spend(spark, str(inbox), out).awaitTermination()
    got = spark.read.parquet(out).first()
    assert (got.Department, got.Entity, got.ExpenditureType) == ("Dé", "a\rb", None)
    (inbox / "b.txt").write_bytes(body.encode())
    with pytest.raises(ValueError, match="several encodings"):
        ingest_spend(spark, str(inbox), out)
