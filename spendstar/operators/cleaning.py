"""Staging -> clean: reject list, redaction, typing, duplicate audit, dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendstar.constants import (
    DAY_FIRST_DATE,
    NATURAL_KEY,
    REDACT_PATTERNS,
    REDACTED_SUPPLIER,
    REJECT_ATTRIBUTE,
    SPEND_COLUMNS,
)
from spendstar.functions.parsing import parse_amount, parse_day_first_date
from spendstar.functions.text import ci_key, contains_any
from spendstar.sources.tables import lookup


def _match_key(c: Column, case_insensitive: bool) -> Column:
    c = F.trim(c)
    return ci_key(c) if case_insensitive else c


def reject_suppliers(df: DataFrame, rejects: DataFrame, key: str = "Supplier",
                     name: str = REJECT_ATTRIBUTE, case_insensitive: bool = False) -> DataFrame:
    """Drop rows whose trimmed supplier is on the reject list.

    A left anti join: a NULL supplier never matches, so it stays.  The
    list is broadcast when its size statistics allow (``lookup``), otherwise
    both sides shuffle on the trimmed name (AQE splits a hot name).
    """
    r = rejects.select(_match_key(F.col(name), case_insensitive).alias("_reject_key"))
    left = df.withColumn("_reject_key", _match_key(F.col(key), case_insensitive))
    return left.join(lookup(r), "_reject_key", "left_anti").drop("_reject_key")


REJECTED_FLAG = "_rejected"
NUL, NULL_SPREAD = "\0", 1 << 16


def mark_rejected(df: DataFrame, rejects: DataFrame, key: str = "Supplier",
                  name: str = REJECT_ATTRIBUTE, case_insensitive: bool = False,
                  flag: str = REJECTED_FLAG) -> DataFrame:
    """Add a boolean ``flag``: the trimmed supplier is on the reject list.

    Same match as :func:`reject_suppliers` (NULL never matches), as a left
    join against the distinct list keys, so a load can count the rejected
    rows in the same pass and filter them afterwards.  A NULL supplier gets a
    key that no list holds, a NUL character and a number by a digest of the rest
    of the row's natural key (of the whole row, where it has none of it): it
    matches nothing and, where the list is too long to broadcast, such rows are
    dealt to all tasks.  No other column is read for it, so a caller that only
    counts moves none through the joins below.
    """
    r = (rejects.select(_match_key(F.col(name), case_insensitive).alias("_reject_key"))
                .where(F.col("_reject_key").isNotNull() & ~F.col("_reject_key").startswith(NUL))
                .distinct().withColumn(flag, F.lit(True)))
    spread = [c for c in NATURAL_KEY if c in df.columns and c != key] or df.columns
    nowhere = F.concat(F.lit(NUL), F.pmod(F.xxhash64(*spread), F.lit(NULL_SPREAD)).cast("string"))
    left = df.withColumn("_reject_key", _match_key(
        F.coalesce(F.col(key), nowhere), case_insensitive))
    return (left.join(lookup(r), "_reject_key", "left").drop("_reject_key")
                .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def redact(df: DataFrame, patterns: Sequence[str] = REDACT_PATTERNS,
           replacement: str = REDACTED_SUPPLIER, columns: Sequence[str] = ("Supplier",),
           case_insensitive: bool = False) -> DataFrame:
    """Replace values containing any pattern with a constant (row-local)."""
    for c in columns:
        df = df.withColumn(
            c, F.when(contains_any(c, patterns, case_insensitive), F.lit(replacement))
                .otherwise(F.col(c)))
    return df


def type_columns(df: DataFrame, date_format: str = DAY_FIRST_DATE,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Typed clean rows: DateOfPayment -> DATE, Amount -> DECIMAL(18,2).

    Parse failures become NULL and the row is kept.  Other text columns are
    passed through untouched (not trimmed).  Extra columns are dropped
    unless named in ``keep``.
    """
    typed = {"DateOfPayment": parse_day_first_date("DateOfPayment", date_format),
             "Amount": parse_amount("Amount")}
    return df.select(*[typed.get(c, F.col(c)).alias(c) for c in SPEND_COLUMNS], *keep)


def duplicate_audit(df: DataFrame, keys: Sequence[str] = NATURAL_KEY) -> DataFrame:
    """Natural keys that occur more than once, with their count.

    Grouping treats NULL keys as equal.  Hash aggregation combines on the
    map side, so a hot key costs one row per map task in the shuffle.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("DuplicateCount"))
              .where(F.col("DuplicateCount") > 1))


def dedup(df: DataFrame, keys: Sequence[str] = NATURAL_KEY,
          case_insensitive: bool = False) -> DataFrame:
    """Keep one row per natural key (NULLs compare equal).

    The survivor is the first row in the order of all remaining columns
    (NULLs first), so reruns and other engines pick the same row.  The rank
    filter sits right on ROW_NUMBER, so Spark applies it on both sides of
    the shuffle (WindowGroupLimit): a hot key sends at most one row per map
    task across the network.  With ``case_insensitive`` text keys compare
    ignoring case and trailing spaces (a server-style collation); the key
    spellings then break remaining ties.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(c).asc_nulls_first() for c in rest]
    part = list(keys)
    if case_insensitive:
        types = dict(df.dtypes)
        part = [ci_key(F.col(k)) if types[k] == "string" else F.col(k) for k in keys]
        order += [F.col(k).asc_nulls_first() for k in keys]
    w = Window.partitionBy(*part).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))


# --- the de-duplication of the load: survivors that carry their row counts ----
PART = "Part"                   # kept, rejected or malformed
SOURCE_ROWS = "SourceRows"      # rows of one natural key, the survivor included
REDACTED_ROWS = "RedactedRows"  # those of them whose supplier is redacted
SOURCE_FILE, RAW_LINE = "SourceFile", "RawLine"  # of malformed rows
LINEAGE = ("_corrupt_record", "source_file")


def dedup_counted(flagged: DataFrame, keys: Sequence[str] = NATURAL_KEY,
                  case_insensitive: bool = False) -> DataFrame:
    """The survivors of :func:`dedup` among the rows that are not rejected, with
    the number of rows behind each; all rejected rows are one more row.

    [14 columns, SourceRows, RedactedRows, SourceFile, RawLine, Part].  One
    aggregate: the survivor is the smallest struct of the remaining columns
    (NULLs first), so a hot key or a common rejected supplier leaves a map task
    as one row.  Every step count of the load is a sum over these columns, so it
    is bound to the rows that were written, whatever tasks or stages were run
    again.

    Where the rows carry the reader's lineage columns, each row that is too
    short or too long also gives a row of part ``malformed`` with its file and
    raw line, in the same pass (the row itself stays in the load).
    """
    lineage = set(LINEAGE) <= set(flagged.columns)
    rows = flagged
    if lineage:
        corrupt, file = (F.col(c) for c in LINEAGE)
        once, twice = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
        rows = rows.withColumn("_report", F.explode(F.when(corrupt.isNotNull(), twice).otherwise(once)))
        report = F.col("_report")
    else:
        report, corrupt, file = F.lit(False), F.lit(None).cast("string"), F.lit(None).cast("string")
    part = F.when(report, "malformed").when(F.col(REJECTED_FLAG), "rejected").otherwise("kept")
    kept = ~report & ~F.col(REJECTED_FLAG)
    rest = [c for c in SPEND_COLUMNS if c not in keys]
    types = dict(flagged.dtypes)
    group = [ci_key(F.col(k)) if case_insensitive and types[k] == "string" else F.col(k) for k in keys]
    named = [F.when(kept, g).alias(f"_k{i}") for i, g in enumerate(group)]
    where = [F.when(report, file).alias(SOURCE_FILE), F.when(report, corrupt).alias(RAW_LINE)] if lineage else []
    # of the keys only text differs within a group, in its spelling
    spelled = [k for k in keys if types[k] == "string"] if case_insensitive else []
    first = rest + spelled
    out = rows.groupBy(part.alias(PART), *named, *where).agg(
        F.min(F.when(kept, F.struct(*first))).alias("_row"),
        F.count(F.lit(1)).alias(SOURCE_ROWS),
        F.count_if(kept & (F.col("Supplier") == F.lit(REDACTED_SUPPLIER))).alias(REDACTED_ROWS))
    at = {c: F.col(f"_row.{c}") for c in first} | {
        k: F.col(f"_k{i}") for i, k in enumerate(keys) if k not in spelled}
    places = [F.col(c) if lineage else F.lit(None).cast("string").alias(c) for c in (SOURCE_FILE, RAW_LINE)]
    return out.select(*[at[c].alias(c) for c in SPEND_COLUMNS], SOURCE_ROWS, REDACTED_ROWS, *places, PART)


def counters_of(written: DataFrame) -> DataFrame:
    """The load's step counts, as one row, from a written ``dedup_counted`` table."""
    kept, rows = F.col(PART) == "kept", F.col(SOURCE_ROWS)

    def total(cond, value):
        return F.coalesce(F.sum(F.when(cond, value)), F.lit(0))
    return written.agg(
        total(F.col(PART) != "malformed", rows).alias("StagingRowCount"),
        total(kept, rows).alias("StagingRowCount_After"),
        total(kept, F.col(REDACTED_ROWS)).alias("RedactedSupplierRows"),
        total(kept, rows).alias("CleanRowCount"),
        total(kept & F.col("DateOfPayment").isNull(), rows).alias("InvalidDateCount"),
        total(kept & F.col("Amount").isNull(), rows).alias("InvalidAmountCount"),
        F.count_if(kept & (rows > 1)).alias("DuplicateGroups"),
        F.count_if(kept).alias("RowCount_AfterDeDup"),
        total(F.col(PART) == "malformed", rows).alias("MalformedRows"))
