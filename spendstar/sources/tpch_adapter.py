"""Spend rows derived from the TPC-H-style test tables.

The reference ships no spend files, so tests and the bench derive them from
the driver's tables: one payment per ``lineitem`` row.  The dirty variant
injects the faults the pipeline must survive (day-first dates without
padding, impossible dates, bad amounts, padded and missing names, personal
names, missing and blank entities, departments and expense types, exact
duplicates).  Each fault is chosen by a modulus
of the order key; every row is kept, duplicates are added.  The same rules
are written in SQL for the DuckDB oracle (``spendstar.checks.oracle``).

Mapping (clean): Department = region name of the supplier's nation,
Entity = nation name, DateOfPayment = ship date as dd/MM/yyyy,
ExpenseType = part type, ExpenseArea = part brand, Supplier = supplier name,
TransactionNumber = orderkey-linenumber, Amount = extended price as
decimal(18,2) text, Description = part name, SupplierPostCode = 'PC' +
nation key, SupplierType = line status, ContractNumber = order key,
ProjectCode = order priority, ExpenditureType = return flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.constants import SPEND_COLUMNS
from spendstar.sources.tables import lookup

# --- fixed values: fault injection (modulus of l_orderkey -> effect) --------
# Later entries win when two rules edit the same field.
UNPADDED_DATE_MOD = 5        # date written d/M/yyyy
POSTCODE_MOD = 7             # postcode NULL (even line number) or blank (odd)
DUPLICATE_MOD = 10           # whole row appended once more
PADDED_SUPPLIER_MOD = 11     # one space each side of the supplier name
BAD_DATE_MOD = 13            # date '31/02/2001'
BAD_AMOUNT_MOD = 17          # amount '1,234.56'
BLANK_ENTITY_MOD = 19        # entity '  '
NULL_AREA_MOD = 23           # expense area NULL
NULL_SUPPLIER_MOD = 29       # supplier NULL
PERSONAL_MOD = 31            # supplier 'Personal Expense <linenumber>'
WITHHELD_MOD = 37            # supplier 'Name Withheld'
EXPONENT_AMOUNT_MOD = 41     # amount '1e3'
NO_TYPE_MOD = 43             # expense type NULL (even line number) or blank (odd)
NO_DEPARTMENT_MOD = 47       # department NULL (even line number) or blank (odd)
REJECT_SUPPKEY_MOD = 4       # suppliers with s_suppkey % 4 = 3 are rejected
REJECT_SUPPKEY_REM = 3
SHORT_REJECT_SUPPKEY_MOD = 20  # the short list: s_suppkey % 20 = 3
BAD_DATE_TEXT = "31/02/2001"
BAD_AMOUNT_TEXT = "1,234.56"
EXPONENT_AMOUNT_TEXT = "1e3"
BLANK_TEXT = "  "


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order, part, supplier, nation and region.

    Each lookup table is joined on its own, so the planner sizes it from its
    own file statistics (broadcast when small, shuffle join when large; all
    but the orders by ``lookup``, whatever the session's threshold).  The
    two that grow with lineitem come first, the orders before the parts: their
    shuffles carry lineitem's own narrow columns and the priority, and none of
    the names that the small tables add.
    """
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (li
            .join(orders, li.l_orderkey == orders.o_orderkey)
            .join(lookup(part), li.l_partkey == part.p_partkey)
            .join(lookup(supplier), li.l_suppkey == supplier.s_suppkey)
            .join(lookup(nation), supplier.s_nationkey == nation.n_nationkey)
            .join(lookup(region), nation.n_regionkey == region.r_regionkey))


def spend_from_tpch(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    """Staging-shaped (all text) payments derived from the test tables."""
    p = _payments(spark, sf_dir)
    k = F.col("l_orderkey")
    ln = F.col("l_linenumber")
    padded_date = F.date_format("l_shipdate", "dd/MM/yyyy")
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    postcode = F.concat(F.lit("PC"), F.col("s_nationkey").cast("string"))
    cols = {
        "Department": F.col("r_name"),
        "Entity": F.col("n_name"),
        "DateOfPayment": padded_date,
        "ExpenseType": F.col("p_type"),
        "ExpenseArea": F.col("p_brand"),
        "Supplier": F.col("s_name"),
        "TransactionNumber": F.concat_ws("-", k.cast("string"), ln.cast("string")),
        "Amount": amount,
        "Description": F.col("p_name"),
        "SupplierPostCode": postcode,
        "SupplierType": F.col("l_linestatus"),
        "ContractNumber": k.cast("string"),
        "ProjectCode": F.col("o_orderpriority"),
        "ExpenditureType": F.col("l_returnflag"),
    }
    if dirty:
        def hit(m: int):
            return (k % m) == 0

        cols["DateOfPayment"] = (
            F.when(hit(BAD_DATE_MOD), F.lit(BAD_DATE_TEXT))
             .when(hit(UNPADDED_DATE_MOD), F.date_format("l_shipdate", "d/M/yyyy"))
             .otherwise(padded_date))
        cols["SupplierPostCode"] = (
            F.when(hit(POSTCODE_MOD) & ((ln % 2) == 0), F.lit(None).cast("string"))
             .when(hit(POSTCODE_MOD), F.lit(""))
             .otherwise(postcode))
        cols["Supplier"] = (
            F.when(hit(WITHHELD_MOD), F.lit("Name Withheld"))
             .when(hit(PERSONAL_MOD), F.concat(F.lit("Personal Expense "), ln.cast("string")))
             .when(hit(NULL_SUPPLIER_MOD), F.lit(None).cast("string"))
             .when(hit(PADDED_SUPPLIER_MOD), F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")))
             .otherwise(F.col("s_name")))
        cols["Amount"] = (
            F.when(hit(EXPONENT_AMOUNT_MOD), F.lit(EXPONENT_AMOUNT_TEXT))
             .when(hit(BAD_AMOUNT_MOD), F.lit(BAD_AMOUNT_TEXT))
             .otherwise(amount))
        for name, mod in (("ExpenseType", NO_TYPE_MOD), ("Department", NO_DEPARTMENT_MOD)):
            cols[name] = (F.when(hit(mod) & ((ln % 2) == 0), F.lit(None).cast("string"))
                           .when(hit(mod), F.lit(BLANK_TEXT)).otherwise(cols[name]))
        cols["Entity"] = F.when(hit(BLANK_ENTITY_MOD), F.lit(BLANK_TEXT)).otherwise(F.col("n_name"))
        cols["ExpenseArea"] = F.when(hit(NULL_AREA_MOD), F.lit(None).cast("string")).otherwise(F.col("p_brand"))
    out = p.select(*[cols[c].cast("string").alias(c) for c in SPEND_COLUMNS], k.alias("_k"))
    if dirty:
        # Exact duplicates: a generator doubles the chosen rows in-stream, so
        # the joins above run once (a self-union would run them twice).
        twice = (F.col("_k") % DUPLICATE_MOD) == 0
        copies = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        out = out.withColumn("_copy", F.explode(copies)).drop("_copy")
    return out.drop("_k")


def rejects_from_tpch(spark: SparkSession, sf_dir: str, mod: int = REJECT_SUPPKEY_MOD) -> DataFrame:
    """Reject-list names derived from the supplier table (``SupplierName``)."""
    s = _table(spark, sf_dir, "supplier")
    return (s.where((F.col("s_suppkey") % mod) == REJECT_SUPPKEY_REM)
             .select(F.col("s_name").alias("SupplierName")))
