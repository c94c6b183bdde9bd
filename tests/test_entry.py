"""Driver contract: entry(), queries() and oracle_sql() agree with DuckDB."""

from __future__ import annotations

import hashlib
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

from spendstar.plans.catalog import QUERIES  # noqa: E402

ROWS_ONLY = {"staging_sample"}


def _norm(v):
    if isinstance(v, Decimal):
        return format(v.normalize(), "f")
    return repr(v) if v is not None else "NULL"


_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE"}


def _duck_type(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return spark_type.upper()
    return _TYPES.get(spark_type, spark_type.upper())


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split():
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["SupplierName", "TotalSpent"]
    assert len(rows) == 3


def test_every_query_has_an_oracle_or_is_rows_only():
    # the training-data queries, which may be absent, have tests of their own
    assert set(QUERIES) - set(E.oracle_sql()) == ROWS_ONLY
    assert set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: _duck_type(t) for c, t in df.dtypes} == duck_types
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(rel.columns, orows)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0
