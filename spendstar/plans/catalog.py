"""Registered queries over the driver's test tables: name -> fn(spark, sf_dir).

Every query derives its spend rows from the given tables (see
``spendstar.sources.tpch_adapter``), so its work grows with them.  The
materialised warehouse is built once per session and input folder and
shared by the queries that read the star schema, the way reports run on a
loaded warehouse.
"""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.constants import SPEND_COLUMNS, TOTAL_TYPE
from spendstar.operators.audit import clean_vs_fact, integrity, stage_counters
from spendstar.operators.cleaning import duplicate_audit
from spendstar.operators.dimensions import DIMENSIONS
from spendstar.operators.fact import unmatched
from spendstar.plans import reports
from spendstar.plans.publish import (
    prepare_namespace,
    publish,
    save_tables,
    save_views,
    saved_tables,
)
from spendstar.plans.warehouse import CleanSteps, Warehouse, build_warehouse, clean_steps
from spendstar.session import scratch_path
from spendstar.sources.delimited import packed, read_spend, write_spend
from spendstar.sources.reject_list import read_reject_list, write_reject_list
from spendstar.sources.tables import materialize
from spendstar.sources.tpch_adapter import (
    REJECT_SUPPKEY_MOD,
    SHORT_REJECT_SUPPKEY_MOD,
    rejects_from_tpch,
    spend_from_tpch,
)

_WAREHOUSES: dict[tuple[str, str, int], Warehouse] = {}
_DATABASES: dict[tuple[str, str], str] = {}
_LOCK = threading.Lock()


def steps_for(spark: SparkSession, sf_dir: str, reject_mod: int = REJECT_SUPPKEY_MOD) -> CleanSteps:
    return clean_steps(spend_from_tpch(spark, sf_dir), rejects_from_tpch(spark, sf_dir, reject_mod))


def _session_key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.conf.get("spark.app.id", str(id(spark))), os.path.abspath(sf_dir)


def warehouse_for(spark: SparkSession, sf_dir: str, reject_mod: int = REJECT_SUPPKEY_MOD) -> Warehouse:
    """The loaded warehouse for ``sf_dir`` (built on first use in this session)."""
    key = (*_session_key(spark, sf_dir), reject_mod)
    with _LOCK:  # queries may be run from several threads: build once
        if key not in _WAREHOUSES:
            _WAREHOUSES[key] = build_warehouse(spend_from_tpch(spark, sf_dir),
                                               rejects_from_tpch(spark, sf_dir, reject_mod))
        return _WAREHOUSES[key]


def _tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "spend-tsv")
    write_spend(spend_from_tpch(spark, sf_dir), path, compression="gzip")
    return read_spend(spark, path, lineage=False).select(*SPEND_COLUMNS)


def _reject_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rejects-xml")
    write_reject_list(rejects_from_tpch(spark, sf_dir), path)
    return read_reject_list(spark, path)


def _counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_counters(spend_from_tpch(spark, sf_dir), rejects_from_tpch(spark, sf_dir))


def _latest_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP 50 clean payments by date, newest first (total order for repeatability)."""
    clean = warehouse_for(spark, sf_dir).clean
    order = [F.col("DateOfPayment").desc_nulls_last()] + [
        F.col(c).asc_nulls_first() for c in
        ("TransactionNumber", "Supplier", "Amount", "Department", "Entity")]
    return (clean.orderBy(*order).limit(50)
                 .select("Department", "Entity", "DateOfPayment", "Supplier", "Amount",
                         "TransactionNumber"))


def _first_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (rejects_from_tpch(spark, sf_dir)
            .orderBy(F.col("SupplierName").asc_nulls_first()).limit(20))


def _staging_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any 50 staged rows (unordered sample, as the reference's sanity check)."""
    return spend_from_tpch(spark, sf_dir).select(
        "Department", "Entity", "DateOfPayment", "Amount", "Supplier", "ExpenseType").limit(50)


def _dimension_samples(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    """The first ``n`` members of each dimension by key, as [dimension, id, member]."""
    wh = warehouse_for(spark, sf_dir)
    layout = {name: (key, list(cols)) for name, (key, cols) in DIMENSIONS.items()}
    layout["DimDate"] = ("DateID", ["FullDate", "Year", "Month", "MonthName"])
    out = None
    for name, (key, cols) in layout.items():
        member = F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL"))
                                      for c in cols])
        part = (wh.dims[name].orderBy(key).limit(n)
                .select(F.lit(name).alias("dimension"), F.col(key).alias("id"),
                        member.alias("member")))
        out = part if out is None else out.unionByName(part)
    return out


def _fact_sample(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    """The first ``n`` fact rows by FactID."""
    fact = warehouse_for(spark, sf_dir).numbered_fact
    return fact.orderBy("FactID").limit(n).select(
        "FactID", "OrganisationID", "SupplierID", "ExpenseTypeID", "ExpenseAreaID", "DateID",
        "Amount", "TransactionNumber")


def _publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(warehouse_for(spark, sf_dir), scratch_path(spark, "published"))


def _database_for(spark: SparkSession, sf_dir: str) -> str:
    """A catalog database with the loaded tables and the report views of ``sf_dir``
    (built on first use in this application)."""
    wh = warehouse_for(spark, sf_dir)
    key = _session_key(spark, sf_dir)
    with _LOCK:
        if key not in _DATABASES:
            name = f"spend_{uuid.uuid4().hex[:12]}"
            save_tables(wh, name, location=scratch_path(spark, name))
            save_views(spark, name)
            _DATABASES[key] = name
        return _DATABASES[key]


def _view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A report view, read by name in a session that did not make it."""
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = _database_for(spark, sf_dir)
        return spark.newSession().table(f"{database}.{name}")
    return read


def _rebuilt_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A namespace dropped, created and filled again: what the catalog then lists."""
    database = f"spend_{uuid.uuid4().hex[:12]}"
    prepare_namespace(spark, database, scratch_path(spark, database))
    spark.sql(f"CREATE TABLE `{database}`.Leftover (x INT) USING parquet")
    prepare_namespace(spark, database, scratch_path(spark, database), reset=True)
    save_tables(warehouse_for(spark, sf_dir), database)
    return saved_tables(spark, database)


def _crlf_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes and a lone carriage return are data; records end in CRLF, in UTF-16."""
    path = scratch_path(spark, "spend-utf16")
    rows = spend_from_tpch(spark, sf_dir).withColumn(
        "Description", F.concat(F.lit('"'), "Description", F.lit('", é')))
    write_spend(rows, path, encoding="UTF-16BE", line_sep="\r\n", compression="gzip")
    return read_spend(spark, path, encoding="UTF-16BE", lineage=False).select(*SPEND_COLUMNS)


def _repaired_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reject-list documents with bare ampersands, repaired; the nested supplier
    and the one in a comment are not on the list."""
    path = scratch_path(spark, "rejects-bare")
    line = F.concat(F.lit('  <Supplier SupplierName="'), "SupplierName", F.lit(' & Sons &amp; Co"/>'))
    docs = (rejects_from_tpch(spark, sf_dir)
            .groupBy(F.pmod(F.xxhash64("SupplierName"), F.lit(4)).alias("part"))
            .agg(F.array_join(F.collect_list(line), "\n").alias("body"))
            .select("part", F.concat(
                F.lit('<?xml version="1.0"?>\n<!-- <Suppliers> -->\n<Suppliers\n kind="list">\n'), "body",
                F.lit('\n<Old><Supplier SupplierName="NESTED"/></Old></Suppliers>\n')).alias("value")))
    docs.write.partitionBy("part").text(path)  # one document a folder
    return read_reject_list(spark, path, repair=True)


def _malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[RawLine, SourceRows] of the rows a load reports as too short or too long."""
    path = scratch_path(spark, "spend-malformed")
    line = F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in SPEND_COLUMNS])
    number = F.col("TransactionNumber")
    lines = spend_from_tpch(spark, sf_dir).select(
        F.when(number.endswith("7-1"), F.substring_index(line, "\t", 10))
         .when(number.endswith("3-2"), F.concat(line, F.lit("\tmore"))).otherwise(line).alias("value"))
    lines.write.options(**packed("gzip")).text(path)
    staging = read_spend(spark, path, header=False, line_sep="\n")
    wh = build_warehouse(staging, rejects_from_tpch(spark, sf_dir))
    return wh.malformed.groupBy("RawLine").agg(F.sum("SourceRows").alias("SourceRows"))


def _case_insensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[SupplierName, ExpenseType, Payments, Total] of a load under the server's
    collation, of rows whose case and trailing blanks vary."""
    number = F.col("TransactionNumber")
    rows = spend_from_tpch(spark, sf_dir) \
        .withColumn("Supplier", F.when(number.endswith("2"), F.lower("Supplier"))
                    .when(number.endswith("3"), F.concat("Supplier", F.lit("  "))).otherwise(F.col("Supplier"))) \
        .withColumn("ExpenseType", F.when(number.endswith("4"), F.lower("ExpenseType"))
                    .otherwise(F.col("ExpenseType")))
    # a generator adds the upper-case rows in-stream: staging is joined once
    copies = F.when(number.endswith("5"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    twice = (rows.withColumn("_upper", F.explode(copies))
             .withColumn("Supplier", F.when(F.col("_upper"), F.upper("Supplier")).otherwise(F.col("Supplier")))
             .drop("_upper"))
    wh = build_warehouse(twice, rejects_from_tpch(spark, sf_dir).select(F.lower("SupplierName")
                                                                       .alias("SupplierName")),
                         case_insensitive=True)
    return (wh.fact.join(wh.dim_supplier, "SupplierID").join(wh.dim_expense_type, "ExpenseTypeID")
            .groupBy("SupplierName", "ExpenseType")
            .agg(F.count(F.lit(1)).alias("Payments"), F.sum("Amount").cast(TOTAL_TYPE).alias("Total")))


def _staging_sample_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[sampled, found]: the rows of the staging sample, and those found in staging.

    The sample (50 rows at most) goes to the staged rows, all of which are looked
    up in it; the different ones among those that match come back.
    """
    sample = _staging_sample(spark, sf_dir)
    staged = spend_from_tpch(spark, sf_dir).select(*sample.columns)
    sample = materialize(sample, "staging-sample")

    def same(left: DataFrame, right: DataFrame) -> list:
        return [left[c].eqNullSafe(right[c]) for c in sample.columns]
    wanted = sample.distinct()
    staged = staged.join(F.broadcast(wanted), same(staged, wanted), "left_semi").distinct()
    found = (sample.join(F.broadcast(staged), same(sample, staged), "left_semi")
             .agg(F.count(F.lit(1))).scalar())
    return sample.agg(F.count(F.lit(1)).alias("sampled")).select("sampled", found.alias("found"))


def _in_order(df: DataFrame, name: str) -> DataFrame:
    """[result_set, position, line] of an ordered report: rows as its caller gets them."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in df.columns])
    stored = materialize(df.select(line.alias("line")).coalesce(1), "in-order")
    return stored.select(F.lit(name).alias("result_set"),
                         F.col("_metadata.row_index").alias("position"), "line")


def _result_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The procedures' result sets in the order they return them."""
    wh = warehouse_for(spark, sf_dir)
    sets = {f"top_suppliers_{k}": df for k, df in reports.top_suppliers_result_sets(wh).items()}
    sets["area_rank_movement"] = reports.area_rank_movement(wh, ordered=True)
    sets["supplier_time_hierarchy"] = reports.supplier_time_hierarchy(wh, ordered=True)
    out = None
    for name, df in sets.items():
        part = _in_order(df, name)
        out = part if out is None else out.unionByName(part)
    return out


def damaged(wh: Warehouse, rejects: DataFrame) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """A warehouse with a known number of faults of each kind the integrity
    report looks for (the same rules are in the oracle)."""
    def edit(df: DataFrame, **columns) -> DataFrame:
        return df.select(*[columns.get(c, F.col(c)).alias(c) for c in df.columns])

    def every(key: str, n: int, value, column: str):
        return F.when(F.col(key) % n == 0, value).otherwise(F.col(column))

    none_int, none_text = F.lit(None).cast("int"), F.lit(None).cast("string")
    dims, long_text = wh.dims, F.repeat(F.lit("x"), F.lit(300))
    dims = dict(
        dims,
        DimOrganisation=edit(dims["DimOrganisation"], OrganisationID=every(
            "OrganisationID", 7, none_int, "OrganisationID"), Entity=every(
            "OrganisationID", 3, long_text, "Entity")),
        DimSupplier=edit(dims["DimSupplier"], SupplierID=every(
            "SupplierID", 10, F.col("SupplierID") - 1, "SupplierID")),
        DimExpenseType=edit(dims["DimExpenseType"], ExpenseTypeID=F.col("ExpenseTypeID") + 4),
        DimDate=edit(dims["DimDate"], MonthName=every("DateID", 100, none_text, "MonthName"),
                     FullDate=every("DateID", 50, F.lit(None).cast("date"), "FullDate")))
    fact = edit(
        wh.numbered_fact,
        FactID=F.when(F.col("FactID") % 100 == 0, F.col("FactID") - 1)
                .when(F.col("FactID") % 777 == 0, F.lit(None).cast("bigint")).otherwise(F.col("FactID")),
        SupplierID=every("FactID", 97, F.col("SupplierID") + 1_000_000, "SupplierID"),
        DateID=every("FactID", 83, none_int, "DateID"),
        TransactionNumber=every("FactID", 1009, long_text, "TransactionNumber"))
    names = rejects.select(F.when(F.col("SupplierName").endswith("3"), none_text)
                            .when(F.col("SupplierName").endswith("7"), long_text)
                            .otherwise(F.col("SupplierName")).alias("SupplierName"))
    return dims, fact, names


def _load_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[metric, value]: every counter of the load, from what it wrote."""
    counters = warehouse_for(spark, sf_dir).counters
    return spark.createDataFrame(sorted(counters.items()), "metric string, value bigint")


def _wh(fn: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(warehouse_for(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stage_spend": lambda spark, d: spend_from_tpch(spark, d),
    "stage_tsv_roundtrip": _tsv_roundtrip,
    "reject_list_xml": _reject_xml,
    "reject_suppliers": lambda spark, d: steps_for(spark, d).rejected.select(*SPEND_COLUMNS),
    "redact_suppliers": lambda spark, d: steps_for(spark, d).redacted.select(*SPEND_COLUMNS),
    "clean_spend": lambda spark, d: steps_for(spark, d).typed,
    "dq_counters": _counters,
    "duplicate_audit": lambda spark, d: duplicate_audit(steps_for(spark, d, SHORT_REJECT_SUPPKEY_MOD).typed),
    "dedup_spend": lambda spark, d: steps_for(spark, d).deduped,
    "dim_organisation": _wh(lambda wh: wh.dims["DimOrganisation"]),
    "dim_supplier": lambda spark, d: warehouse_for(spark, d, SHORT_REJECT_SUPPKEY_MOD).dims["DimSupplier"],
    "dim_expense_type": _wh(lambda wh: wh.dims["DimExpenseType"]),
    "dim_expense_area": _wh(lambda wh: wh.dims["DimExpenseArea"]),
    "dim_date": _wh(lambda wh: wh.dims["DimDate"]),
    "fact_spend": _wh(lambda wh: wh.numbered_fact),
    "unmatched_by_dimension": _wh(lambda wh: unmatched(wh.clean, wh.dims)),
    "clean_vs_fact": _wh(lambda wh: clean_vs_fact(wh.clean, wh.fact)),
    "integrity_report": lambda spark, d: integrity(
        warehouse_for(spark, d).dims, warehouse_for(spark, d).numbered_fact, rejects_from_tpch(spark, d)),
    "integrity_of_damage": lambda spark, d: integrity(
        *damaged(warehouse_for(spark, d), rejects_from_tpch(spark, d))),
    "load_counters": _load_counters,
    "top_suppliers": _wh(reports.top_suppliers),
    "top_suppliers_monthly": _wh(reports.top_suppliers_monthly),
    "expense_types_above_avg": _wh(reports.expense_types_above_avg),
    "expense_types_above_avg_json": _wh(reports.expense_types_above_avg_json),
    "area_rank_movement": _wh(reports.area_rank_movement),
    "supplier_time_hierarchy": _wh(reports.supplier_time_hierarchy),
    "latest_payments": _latest_payments,
    "first_rejects": _first_rejects,
    "staging_sample": _staging_sample,
    "dimension_samples": _dimension_samples,
    "fact_sample": _fact_sample,
    "publish_warehouse": _publish,
    "rebuilt_namespace": _rebuilt_namespace,
    "view_top_suppliers": _view("vw_Top3Suppliers"),
    "view_top_suppliers_monthly": _view("vw_Top3Suppliers_Monthly"),
    "view_expense_types_above_avg": _view("vw_ExpenseTypeAboveAvg2Month"),
    "view_area_rank_movement": _view("vw_MonthlyExpenseAreaRanking"),
    "view_supplier_time_hierarchy": _view("vw_SupplierTimeHierarchyAnalysis"),
    "procedure_result_sets": _result_sets,
    "stage_utf16_crlf_roundtrip": _crlf_roundtrip,
    "reject_list_repaired": _repaired_rejects,
    "malformed_rows": _malformed_rows,
    "load_case_insensitive": _case_insensitive,
    "staging_sample_check": _staging_sample_check,
}
