"""Command line: load files into a warehouse folder, then report from it."""

from __future__ import annotations

import toy
from spendstar.__main__ import main
from spendstar.plans.warehouse import open_warehouse
from spendstar.sources.delimited import write_spend


def test_load_then_report(spark, tmp_path, capsys):
    write_spend(toy.staging(spark).coalesce(1), str(tmp_path / "raw"))
    xml = tmp_path / "rejects.xml"
    xml.write_text('<Suppliers><Supplier SupplierName="BAD CO"/></Suppliers>\n')
    wh = str(tmp_path / "wh")
    assert main(["load", "--spend", str(tmp_path / "raw"), "--rejects", str(xml), "--out", wh]) == 0
    out = capsys.readouterr().out
    assert '"StagingRowCount": 14' in out and "unmatched Organisation: 1" in out
    target = str(tmp_path / "top")
    assert main(["report", "top_suppliers", "--warehouse", wh, "--output", target]) == 0
    rows = sorted(tuple(r) for r in spark.read.parquet(target).collect())
    assert [r[0] for r in rows] == ["ACME LTD", "BETA", "BETA"]
    assert main(["report", "area_rank_movement", "--warehouse", wh, "--ordered"]) == 0
    assert "North" in capsys.readouterr().out


def test_ingest_then_views(spark, tmp_path, capsys):
    write_spend(toy.staging(spark).coalesce(1), str(tmp_path / "inbox"))
    args = ["ingest", "--inbox", str(tmp_path / "inbox"), "--staging", str(tmp_path / "stg"),
            "--checkpoint", str(tmp_path / "ckpt")]
    assert main(args) == 0
    assert '"staging_rows": 14' in capsys.readouterr().out
    assert main(args) == 0  # nothing new: still 14
    assert '"staging_rows": 14' in capsys.readouterr().out
    assert main(["views"]) == 0
    assert "vw_Top3Suppliers" in capsys.readouterr().out


def test_ingest_load_publish(spark, tmp_path, capsys):
    """Files in UTF-16, one row too short: staging table -> warehouse -> catalog."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    rows = [[v or "" for v in r] for r in toy.staging(spark).collect()]
    lines = ["\t".join(toy.SPEND_COLUMNS)] + ["\t".join(r) for r in rows] + ["Short\trow"]
    (inbox / "a.txt").write_bytes(b"\xff\xfe" + "".join(x + "\r\n" for x in lines).encode("UTF-16LE"))
    xml = tmp_path / "rejects.xml"
    xml.write_text('<Suppliers><Supplier SupplierName="BAD CO"/></Suppliers>\n')
    staging, wh = str(tmp_path / "stg"), str(tmp_path / "wh")
    assert main(["ingest", "--inbox", str(inbox), "--staging", staging]) == 0
    assert '"staging_rows": 15' in capsys.readouterr().out
    assert main(["load", "--staging", staging, "--rejects", str(xml), "--out", wh]) == 0
    assert '"MalformedRows": 1' in capsys.readouterr().out
    loaded = open_warehouse(spark, wh)
    bad = loaded.malformed.collect()
    assert [(r.RawLine, r.SourceRows) for r in bad] == [("Short\trow", 1)]
    assert bad[0].SourceFile.endswith("a.txt") and loaded.counters["FactRows"] == 9
    assert main(["publish", "--warehouse", wh, "--database", "spend_cli"]) == 0
    assert "spend_cli.vw_Top3Suppliers" in capsys.readouterr().out
    assert spark.newSession().table("spend_cli.vw_Top3Suppliers").count() == 3
    # the same file read directly, by its own encoding and line ending
    direct = str(tmp_path / "direct")
    assert main(["load", "--spend", str(inbox), "--rejects", str(xml), "--out", direct]) == 0
    assert open_warehouse(spark, direct).counters == loaded.counters
