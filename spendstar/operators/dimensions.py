"""Star-schema dimensions built from the clean payments.

Each dimension is the DISTINCT set of its normalised attributes (trimmed,
blank -> NULL; a NULL member is kept) with a dense surrogate key in the
sort order of the attributes.  The date dimension keeps non-NULL dates and
adds Year, Month and MonthName.

``build_dimensions`` makes all five in one pass: one scan of the clean rows,
GROUPING SETS over the five attribute lists (hash aggregate with map-side
combine, so the shuffle carries at most one row per member per map task),
one range-partitioned key assignment for all members, written partitioned
by dimension so each dimension is its own folder with its own size
statistics (which the fact load's broadcast decisions rely on).
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendstar.functions.text import ci_key, norm_text
from spendstar.operators.keys import dense_keys
from spendstar.session import scratch_path

# --- fixed values: dimension layout (key, {output column: clean column}) ----
DIMENSIONS = {
    "DimOrganisation": ("OrganisationID", {"Department": "Department", "Entity": "Entity"}),
    "DimSupplier": ("SupplierID", {"SupplierName": "Supplier",
                                   "SupplierPostCode": "SupplierPostCode",
                                   "SupplierType": "SupplierType"}),
    "DimExpenseType": ("ExpenseTypeID", {"ExpenseType": "ExpenseType"}),
    "DimExpenseArea": ("ExpenseAreaID", {"ExpenseArea": "ExpenseArea"}),
}
DATE_DIMENSION = ("DimDate", "DateID")
ROWS = "_rows"  # clean rows that hold a member


def dimension_members(clean: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Distinct normalised members (before keys are assigned)."""
    return clean.select(*[norm_text(src).alias(out) for out, src in columns.items()]).distinct()


def build_dimension(clean: DataFrame, columns: Mapping[str, str], key: str,
                    name: str = "dim") -> DataFrame:
    """One dimension: [key, *columns], key = 1..n in attribute order, NULLs first."""
    members = dimension_members(clean, columns)
    return dense_keys(members, list(columns), key, name=name)


def _date_columns(key: str) -> list:
    return [key, "FullDate",
            F.year("FullDate").alias("Year"),
            F.month("FullDate").alias("Month"),
            F.date_format("FullDate", "MMMM").alias("MonthName")]


def build_date_dimension(clean: DataFrame, column: str = "DateOfPayment",
                         key: str = "DateID") -> DataFrame:
    """One date dimension: [DateID, FullDate, Year, Month, MonthName], non-NULL dates."""
    dates = (clean.where(F.col(column).isNotNull())
                  .select(F.col(column).alias("FullDate")).distinct())
    return dense_keys(dates, ["FullDate"], key, name="DimDate").select(*_date_columns(key))


def canonical_spellings(members: DataFrame, columns: list[str]) -> DataFrame:
    """Case-insensitive members: each text value becomes its class's spelling.

    A class is all values of one column of one dimension that are equal
    ignoring case; its spelling is the smallest in binary order, so reruns
    agree.  The class table is an aggregate (map-side combined) joined back;
    NULL stays NULL.  Members that become equal collapse into one, and their
    row counts add up.
    """
    for c in columns:
        key = ci_key(F.col(c))
        spelling = (members.where(F.col(c).isNotNull())
                    .groupBy("dim", key.alias("_ci")).agg(F.min(c).alias("_canon")))
        members = (members.withColumn("_ci", key)
                   .join(spelling, ["dim", "_ci"], "left")
                   .withColumn(c, F.coalesce(F.col("_canon"), F.col(c)))
                   .drop("_ci", "_canon"))
    keys = [c for c in members.columns if c != ROWS]
    return members.groupBy(*keys).agg(F.sum(ROWS).alias(ROWS))


def keyed_members(clean: DataFrame, case_insensitive: bool = False) -> tuple[str, T.StructType]:
    """All members of the five dimensions with their keys and the number of
    clean rows that hold them (``_rows``), from one scan of ``clean``.

    Written to the shared folder, one sub-folder for each dimension; returns
    the folder and the sub-folders' schema.  With ``case_insensitive`` members
    that differ only in case are one member, spelled as
    :func:`canonical_spellings` chooses.
    """
    attrs: dict[str, str] = {}
    sets: dict[str, list[str]] = {}
    for name, (_key, cols) in DIMENSIONS.items():
        sets[name] = list(cols)
        attrs.update(cols)
    date_name, date_key = DATE_DIMENSION
    attrs["FullDate"] = "DateOfPayment"
    sets[date_name] = ["FullDate"]
    names = list(attrs)
    projected = clean.select(*[
        (F.col(src) if out == "FullDate" else norm_text(src)).alias(out)
        for out, src in attrs.items()])
    members = projected.groupingSets([sets[n] for n in sets], *names).agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias(ROWS))
    # grouping_id(): bit i (from the left) is 1 when names[i] is not grouped.
    gid = {n: sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in cols)
           for n, cols in sets.items()}
    dim_of = F.lit(None).cast("string")
    for n, g in gid.items():
        dim_of = F.when(F.col("_gid") == g, F.lit(n)).otherwise(dim_of)
    members = (members.select(dim_of.alias("dim"), *names, ROWS)
                      .where((F.col("dim") != date_name) | F.col("FullDate").isNotNull()))
    if case_insensitive:
        members = canonical_spellings(members, [n for n in names if n != "FullDate"])
    base = scratch_path(clean.sparkSession, "dimensions")
    keyed = dense_keys(members, names, "_key", by="dim", name="dimensions",
                       partition_by=["dim"], path=base)
    return base, keyed.drop("dim").schema


def read_members(spark, base: str, schema: T.StructType) -> dict[str, DataFrame]:
    """[key, attributes, _rows] of the five dimensions that ``keyed_members`` wrote."""
    layout = {name: (key, list(cols)) for name, (key, cols) in DIMENSIONS.items()}
    layout[DATE_DIMENSION[0]] = (DATE_DIMENSION[1], ["FullDate"])
    out = {}
    for name, (key, cols) in layout.items():
        try:
            part = spark.read.schema(schema).parquet(os.path.join(base, f"dim={name}"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # unreadable is not empty
            # the write succeeded, so no folder means no members
            part = spark.createDataFrame([], schema)
        out[name] = part.select(F.col("_key").alias(key), *cols, ROWS)
    return out


def as_dimensions(members: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The dimension tables (without row counts; dates with their parts)."""
    date_name, date_key = DATE_DIMENSION
    return {name: df.select(*_date_columns(date_key)) if name == date_name else df.drop(ROWS)
            for name, df in members.items()}


def build_dimensions(clean: DataFrame, case_insensitive: bool = False) -> dict[str, DataFrame]:
    """All five dimensions from one scan of ``clean``, keyed by table name."""
    return as_dimensions(read_members(clean.sparkSession, *keyed_members(clean, case_insensitive)))
