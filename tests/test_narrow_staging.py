"""What staging moves: narrow rows through the large joins, packed text files."""

from __future__ import annotations

import glob
import re

import toy
from spendstar.constants import SPEND_COLUMNS
from spendstar.sources import delimited
from spendstar.sources.delimited import read_spend, write_spend
from spendstar.sources.tpch_adapter import spend_from_tpch
from test_reject_lists import _tables


def test_large_tables_are_joined_before_the_small_ones_add_names(spark, tmp_path):
    _tables(spark, str(tmp_path))
    plan = spend_from_tpch(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    joins = re.findall(r"Join Inner, \((\w+)#", plan)  # from the last to the first
    assert joins == ["n_regionkey", "s_nationkey", "l_suppkey", "l_partkey", "l_orderkey"]


def test_packed_files_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(delimited, "ROWS_PER_PACKED_FILE", 5)
    rows, path = toy.staging(spark).coalesce(1), str(tmp_path / "packed")
    write_spend(rows, path, line_sep="\r\n", compression="gzip")
    assert len(glob.glob(f"{path}/*.gz")) == 3  # 14 rows
    back = read_spend(spark, path, lineage=False)  # encoding and line ending from the text, not the packing
    assert sorted(map(repr, back.select(*SPEND_COLUMNS).collect())) == sorted(
        map(repr, rows.replace("", None).collect()))


def test_byte_order_mark_of_a_packed_file(spark, tmp_path):
    import gzip

    line = "\t".join(f"v{i}" for i in range(len(SPEND_COLUMNS)))
    text = "\t".join(SPEND_COLUMNS) + "\r\n" + line + "\r\n"
    (tmp_path / "utf16.tsv.gz").write_bytes(gzip.compress(b"\xff\xfe" + text.encode("UTF-16LE")))
    assert [tuple(r) for r in read_spend(spark, str(tmp_path / "utf16.tsv.gz"), lineage=False).collect()] == [
        tuple(line.split("\t"))]
