"""Queries on the short reject list: suppliers that only the long list names stay."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E

SUPPLIERS = 40


def _tables(spark, at: str) -> None:
    """A payment by each of 40 suppliers; the orders 0, 10, 20 and 30 come twice in staging."""
    n = spark.range(SUPPLIERS)
    number = F.col("id").cast("string")
    tables = {
        "region": spark.createDataFrame([(0, "EUROPE")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(0, "FRANCE", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": n.select(F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), number).alias("s_name"),
                             F.lit(0).alias("s_nationkey")),
        "part": n.select(F.col("id").alias("p_partkey"), F.lit("bolt").alias("p_name"),
                         F.lit("SMALL").alias("p_type"), F.lit("Brand#1").alias("p_brand")),
        "orders": n.select(F.col("id").alias("o_orderkey"), F.lit("1-URGENT").alias("o_orderpriority")),
        "lineitem": n.select(
            F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"),
            ((F.col("id") + 7) % SUPPLIERS).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
            F.lit(10.5).alias("l_extendedprice"), F.lit("N").alias("l_returnflag"),
            F.lit("O").alias("l_linestatus"), F.to_timestamp(F.lit("1997-03-04")).alias("l_shipdate")),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{at}/{name}.parquet")


def test_short_list_keeps_suppliers_that_only_the_long_list_names(spark, tmp_path):
    at = str(tmp_path)
    _tables(spark, at)
    con = duckdb.connect()
    for name in "region nation supplier part orders lineitem".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{at}/{name}.parquet/*.parquet')")

    names = {r.SupplierName for r in E.queries()["dim_supplier"](spark, at).collect()}
    # S15 pays for order 8 and S27 for order 20: on the long list (% 4 = 3), not on the short one
    assert {"S15", "S27"} <= names and not {"S3", "S23"} & names
    audit = {r.TransactionNumber: r.Supplier for r in E.queries()["duplicate_audit"](spark, at).collect()}
    assert audit["20-1"] == "S27" and audit["10-1"] == "S17" and len(audit) == 4
    for query in ("dim_supplier", "duplicate_audit"):
        wanted = con.sql(E.oracle_sql()[query]).fetchall()
        assert len(wanted) == E.queries()[query](spark, at).count()
