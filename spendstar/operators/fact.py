"""Fact load: strict star join of the clean payments to the five dimensions.

The clean rows get their normalised join keys once; every dimension is then
joined on plain columns.  Dimensions are materialised Parquet with real size
statistics: the planner broadcasts them when they are under
``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffle join,
with AQE skew splitting, when a dimension is large.  The matched rows are
dealt to files by date (one shuffle), sorted, and numbered by file and row.

Matching rules: organisation, supplier name, expense type and area compare
with ``=`` after trim (NULL or blank never matches, those rows are lost by
design); supplier postcode and type treat NULL and blank as equal; the date
matches exactly (an unparsable date never matches).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendstar.functions.text import ci_key, norm_key, norm_text
from spendstar.operators.keys import row_ids

# --- fixed values: fact layout ------------------------------------------------
FACT_KEYS = ("OrganisationID", "SupplierID", "ExpenseTypeID", "ExpenseAreaID", "DateID")
FACT_MEASURES = ("Amount", "TransactionNumber", "Description")
# --- fixed values: in-flight counter names of the row-loss diagnostics ------
MISS_COUNTERS = {
    "OrganisationID": "NoOrganisationMatch",
    "SupplierID": "NoSupplierMatch",
    "ExpenseTypeID": "NoExpenseTypeMatch",
    "ExpenseAreaID": "NoExpenseAreaMatch",
    "DateID": "NoDateMatch",
}
# the dimension of each fact key and its attributes that must not be NULL to match
STRICT_KEYS = {
    "OrganisationID": ("DimOrganisation", ("Department", "Entity")),
    "SupplierID": ("DimSupplier", ("SupplierName",)),
    "ExpenseTypeID": ("DimExpenseType", ("ExpenseType",)),
    "ExpenseAreaID": ("DimExpenseArea", ("ExpenseArea",)),
    "DateID": ("DimDate", ("FullDate",)),
}
# dimension name reported by the diagnostics, in report order
DIAGNOSTIC_NAMES = {
    "OrganisationID": "Organisation",
    "SupplierID": "Supplier",
    "ExpenseTypeID": "ExpenseType",
    "ExpenseAreaID": "ExpenseArea",
    "DateID": "Date",
}


def _match_keys(clean: DataFrame, dims: dict[str, DataFrame], case_insensitive: bool = False):
    """(clean rows with normalised match keys, {fact key: (dimension side, key columns)})."""
    def k(c):
        return ci_key(c) if case_insensitive else c

    rows = clean.select(
        "*",
        k(norm_text("Department")).alias("_dept"),
        k(norm_text("Entity")).alias("_ent"),
        k(norm_text("Supplier")).alias("_sup"),
        k(norm_key("SupplierPostCode")).alias("_pc"),
        k(norm_key("SupplierType")).alias("_st"),
        k(norm_text("ExpenseType")).alias("_et"),
        k(norm_text("ExpenseArea")).alias("_ea"),
        F.col("DateOfPayment").alias("_date"),
    )
    org = dims["DimOrganisation"].select(
        "OrganisationID", k(F.col("Department")).alias("_dept"), k(F.col("Entity")).alias("_ent"))
    sup = dims["DimSupplier"].select(
        "SupplierID", k(F.col("SupplierName")).alias("_sup"),
        k(norm_key("SupplierPostCode")).alias("_pc"), k(norm_key("SupplierType")).alias("_st"))
    et = dims["DimExpenseType"].select("ExpenseTypeID", k(F.col("ExpenseType")).alias("_et"))
    ea = dims["DimExpenseArea"].select("ExpenseAreaID", k(F.col("ExpenseArea")).alias("_ea"))
    dd = dims["DimDate"].select("DateID", F.col("FullDate").alias("_date"))
    return rows, {"OrganisationID": (org, ["_dept", "_ent"]),
                  "SupplierID": (sup, ["_sup", "_pc", "_st"]),
                  "ExpenseTypeID": (et, ["_et"]),
                  "ExpenseAreaID": (ea, ["_ea"]),
                  "DateID": (dd, ["_date"])}


def match_dimensions(clean: DataFrame, dims: dict[str, DataFrame],
                     case_insensitive: bool = False) -> DataFrame:
    """Clean rows with the five dimension keys (NULL where a dimension missed).

    With ``case_insensitive`` text keys compare under the server's collation.
    """
    rows, sides = _match_keys(clean, dims, case_insensitive)
    for dim, on in sides.values():
        rows = rows.join(dim, on, "left")
    return rows.drop(*[c for _, on in sides.values() for c in on])


def fact_rows(matched: DataFrame) -> DataFrame:
    """Rows that matched every dimension, in fact layout (no FactID)."""
    cond = None
    for k in FACT_KEYS:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return matched.where(cond).select(*FACT_KEYS, *FACT_MEASURES)


def star_join(clean: DataFrame, dims: dict[str, DataFrame],
              case_insensitive: bool = False) -> DataFrame:
    """The clean rows that match every dimension, in fact layout (no FactID).

    The filter on the five keys makes the joins inner joins, so Spark drops
    rows with a NULL match key at the scan: no such row is shuffled when a
    dimension is too large to broadcast.  Their number is known from the
    members (:func:`member_losses`).
    """
    return fact_rows(match_dimensions(clean, dims, case_insensitive))


# --- layout of the stored fact -------------------------------------------------
# The total order of the stored fact, and so of its FactIDs: by date, within a
# date by a digest (so that a date that holds very many rows can be dealt to
# many files in order), then by all remaining columns.
SALT_COLUMNS = ("TransactionNumber", "SupplierID", "Amount")
SALTS = 1 << 16
FACT_ORDER = ("DateID", "_salt", "SupplierID", "TransactionNumber", "Amount", "OrganisationID",
              "ExpenseTypeID", "ExpenseAreaID", "Description")


def fact_salt() -> Column:
    """0 .. 65535 from the first four hexadecimal digits of the row's MD5."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in SALT_COLUMNS]))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")


def date_layout(date_rows: DataFrame, rows_per_file: int) -> DataFrame:
    """[DateID, _first, _files]: the first file of each date and their number.

    ``date_rows``: [DateID, _rows].  Files are filled in date order; a date of
    more than ``rows_per_file`` rows is dealt to several, by salt.  The window
    runs over one row for each calendar day.
    """
    before = F.coalesce(F.sum("_rows").over(
        Window.orderBy("DateID").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return date_rows.select(
        "DateID", F.floor(before / F.lit(rows_per_file)).cast("int").alias("_first"),
        F.greatest(F.floor(F.col("_rows") / F.lit(rows_per_file)), F.lit(1)).cast("int").alias("_files"))


def lay_out(rows: DataFrame, layout: DataFrame, files: int) -> DataFrame:
    """Fact rows dealt to ``files`` partitions in ``FACT_ORDER`` and sorted.

    The partition is computed from the date's place in the layout, so no
    sampling pass over the joins is needed, a retried task deals the same, and
    the order of the rows does not depend on the number of files.
    """
    part = F.col("_first") + F.floor(F.col("_salt") * F.col("_files") / F.lit(SALTS)).cast("int")
    return (rows.join(F.broadcast(layout), "DateID")  # one row for each calendar day
                .withColumn("_salt", fact_salt())
                .repartitionById(files, part)
                .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in FACT_ORDER])
                .select(*FACT_KEYS, *FACT_MEASURES))


def file_ranges(stored: DataFrame) -> DataFrame:
    """[Part, FirstID, Rows, MinDateID, MaxDateID] of each file of a stored fact.

    One scan of DateID; the window that adds up the rows before each file runs
    over one row for each file.
    """
    files = stored.groupBy(_file_part().alias("Part")).agg(
        F.count(F.lit(1)).alias("Rows"), F.min("DateID").alias("MinDateID"),
        F.max("DateID").alias("MaxDateID"))
    before = F.sum("Rows").over(Window.orderBy("Part").rowsBetween(Window.unboundedPreceding, -1))
    return files.select("Part", (F.coalesce(before, F.lit(0)) + 1).alias("FirstID"), "Rows",
                        "MinDateID", "MaxDateID")


def _file_part() -> Column:
    """A part file's number, which orders the files of one write."""
    return F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("int")


def with_fact_ids(stored: DataFrame, ranges: list) -> DataFrame:
    """The stored fact with a dense BIGINT FactID 1..n in ``FACT_ORDER``.

    FactID = the rows before the file + the row's index in it, both from
    metadata: nothing is shuffled or stored, and a plan that does not use
    FactID does not compute it.  ``ranges`` are the rows of
    :func:`file_ranges` (one for each file; eight bytes each in the plan).
    """
    first = {r.Part: r.FirstID for r in ranges}
    listed = ",".join(str(first.get(p, 0)) for p in range(max(first, default=0) + 1))
    ids = F.split(F.lit(listed), ",").cast("array<bigint>")  # folded to one literal
    fact_id = F.element_at(ids, _file_part() + 1) + F.col("_metadata.row_index")
    return stored.select(fact_id.alias("FactID"), *FACT_KEYS, *FACT_MEASURES)


def member_losses(members: dict[str, DataFrame]) -> tuple[dict[str, int], int]:
    """(rows lost at each dimension, rows with a date), from the members' row
    counts (``_rows``).

    A row misses a dimension that was built from the same clean rows exactly
    when one of its strict match keys is NULL: NULL members keep their key but
    never match, and the date dimension leaves them out.
    """
    sums = None
    for key, (name, strict) in STRICT_KEYS.items():
        cond = F.lit(False)
        for c in strict:
            cond = cond | F.col(c).isNull()
        part = members[name].select(F.lit(key).alias("key"), "_rows", cond.alias("_none"))
        sums = part if sums is None else sums.unionByName(part)
    found = {r.key: r for r in sums.groupBy("key").agg(  # five rows
        F.sum("_rows").alias("rows"), F.sum(F.when(F.col("_none"), F.col("_rows"))).alias("lost")).collect()}
    lost = {MISS_COUNTERS[k]: int(found[k].lost or 0) if k in found else 0 for k in STRICT_KEYS}
    dated = int(found["DateID"].rows) if "DateID" in found else 0
    whole = int(found["OrganisationID"].rows) if "OrganisationID" in found else 0
    return lost | {MISS_COUNTERS["DateID"]: whole - dated}, dated


def build_fact(clean: DataFrame, dims: dict[str, DataFrame],
               case_insensitive: bool = False) -> DataFrame:
    """FactInvoice rows of any clean table and dimensions, lazily: a unique
    (not dense) FactID, five keys, Amount, TransactionNumber, Description."""
    return row_ids(star_join(clean, dims, case_insensitive), "FactID")


def unmatched(clean: DataFrame, dims: dict[str, DataFrame],
              case_insensitive: bool = False) -> DataFrame:
    """[dimension, unmatched_rows]: clean rows with no match in each dimension.

    The clean rows are first counted by the match keys of each dimension
    (GROUPING SETS, combined on the map side: a NULL or hot key leaves a task
    as one row), then only the counted keys are joined to the dimensions.
    """
    rows, sides = _match_keys(clean, dims, case_insensitive)
    names = [c for _, on in sides.values() for c in on]
    counted = rows.groupingSets([on for _, on in sides.values()], *names).agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("_n"))
    out = None
    for key, (dim, on) in sides.items():
        # grouping_id(): bit i (from the left) is 1 when names[i] is not grouped
        gid = sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in on)
        lost = (counted.where(F.col("_gid") == gid).join(dim, on, "left_anti")
                .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("unmatched_rows"))
                .select(F.lit(DIAGNOSTIC_NAMES[key]).alias("dimension"), "unmatched_rows"))
        out = lost if out is None else out.unionByName(lost)
    return out
