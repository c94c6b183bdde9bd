"""Row audits, data-quality counters and integrity checks.

Every check is a global aggregate (map-side partial, one row out) so a
whole step is audited in one scan; results come back as small
``[metric, value]`` frames that can be unioned, shown or asserted on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.constants import NATURAL_KEY, REDACTED_SUPPLIER, REJECT_ATTRIBUTE, TEXT_LIMITS
from spendstar.functions.text import ci_key
from spendstar.operators.cleaning import REJECTED_FLAG, mark_rejected, redact, type_columns
from spendstar.operators.dimensions import DATE_DIMENSION, DIMENSIONS
from spendstar.operators.fact import FACT_KEYS


def _metrics(df: DataFrame, label: str = "metric", value: str = "value") -> DataFrame:
    """Unpivot a one-row aggregate into [label, value] rows (value BIGINT)."""
    pairs = [F.struct(F.lit(c).alias(label), F.col(f"`{c}`").cast("bigint").alias(value))
             for c in df.columns]
    return df.select(F.explode(F.array(*pairs)).alias("_m")).select(f"_m.{label}", f"_m.{value}")


def stage_counters(staging: DataFrame, rejects: DataFrame, case_insensitive: bool = False,
                   redact_columns=("Supplier",)) -> DataFrame:
    """The reference's step counts, one row per metric.

    All but InvalidSupplierCount (from the list) come from one pass over the
    flagged rows, grouped by the natural key; the rejected rows are one more
    group.  The number of groups is the number of rows de-duplication keeps,
    and the counts of rows are sums over the groups: date and amount are part
    of the key.
    """
    flagged = type_columns(
        redact(mark_rejected(staging, rejects, case_insensitive=case_insensitive),
               columns=redact_columns, case_insensitive=case_insensitive),
        keep=[REJECTED_FLAG])
    kept = ~F.col(REJECTED_FLAG)
    types = dict(flagged.dtypes)
    natural = {k: ci_key(F.col(k)) if case_insensitive and types[k] == "string" else F.col(k)
               for k in NATURAL_KEY}
    groups = (flagged.groupBy(*[F.when(kept, c).alias(f"_{k}") for k, c in natural.items()],
                              kept.alias("_kept"))
              .agg(F.count(F.lit(1)).alias("_n"),
                   F.count_if(kept & (F.col("Supplier") == F.lit(REDACTED_SUPPLIER))).alias("_redacted")))
    listed = rejects.agg(F.count(F.lit(1))).scalar()

    def rows(cond, value="_n"):
        return F.coalesce(F.sum(F.when(cond, F.col(value))), F.lit(0))
    steps = groups.agg(
        rows(F.lit(True)).alias("StagingRowCount"),
        rows(F.col("_kept")).alias("StagingRowCount_After"),
        rows(F.col("_kept"), "_redacted").alias("RedactedSupplierRows"),
        rows(F.col("_kept")).alias("CleanRowCount"),
        rows(F.col("_kept") & F.col("_DateOfPayment").isNull()).alias("InvalidDateCount"),
        rows(F.col("_kept") & F.col("_Amount").isNull()).alias("InvalidAmountCount"),
        F.count_if(F.col("_kept") & (F.col("_n") > 1)).alias("DuplicateGroups"),
        F.count_if(F.col("_kept")).alias("RowCount_AfterDeDup"))
    names = list(steps.columns)
    names.insert(6, "InvalidSupplierCount")
    return _metrics(steps.select("*", listed.alias("InvalidSupplierCount")).select(*names))


def clean_vs_fact(clean: DataFrame, fact: DataFrame) -> DataFrame:
    """CleanRows, FactRows and LostRows (clean rows that missed a dimension)."""
    fact_rows = fact.agg(F.count(F.lit(1))).scalar()  # a scalar subquery
    both = clean.agg(F.count(F.lit(1)).alias("CleanRows")).select(
        "CleanRows", fact_rows.alias("FactRows"))
    return _metrics(both.select("CleanRows", "FactRows",
                                (F.col("CleanRows") - F.col("FactRows")).alias("LostRows")))


def _dimension_checks(name: str, dim: DataFrame, key: str, not_null: list[str]) -> DataFrame:
    aggs = [
        F.count_if(F.col(key).isNull()).alias(f"{name}.{key}.null"),
        (F.count(F.lit(1)) - F.count_distinct(key)).alias(f"{name}.{key}.duplicate"),
        # dense 1..n keys: max equals the row count and min is 1
        F.coalesce(F.max(key) - F.count(F.lit(1)), F.lit(0)).alias(f"{name}.{key}.gaps"),
        F.coalesce(F.min(key) - 1, F.lit(0)).alias(f"{name}.{key}.start"),
    ]
    for col in not_null:
        aggs.append(F.count_if(F.col(col).isNull()).alias(f"{name}.{col}.null"))
    for col, limit in TEXT_LIMITS.get(name, {}).items():
        aggs.append(F.count_if(F.length(col) > limit).alias(f"{name}.{col}.too_long"))
    return _metrics(dim.agg(*aggs), "check", "violations")


def duplicate_ids(fact: DataFrame, key: str) -> DataFrame:
    """[duplicates]: rows whose ``key`` another row has too, all but one of each.

    The distinct ids are counted in bitmaps of 32,768 consecutive ids, filled
    before the shuffle: the exchange carries one bitmap (4 KB) for each such
    stretch of ids in a task, an eighth of a byte an id, and no id.
    """
    held = (fact.where(F.col(key).isNotNull())
                .groupBy(F.bitmap_bucket_number(F.col(key)).alias("_stretch"))
                .agg(F.count(F.lit(1)).alias("_n"),
                     F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("_ids")))
    return held.agg(F.coalesce(F.sum(F.col("_n") - F.bitmap_count("_ids")), F.lit(0)).alias("duplicates"))


def integrity(dims: dict[str, DataFrame], fact: DataFrame,
              rejects: DataFrame | None = None) -> DataFrame:
    """[check, violations]: keys, NOT NULL, lengths, and fact -> dimension keys.

    Every violation count should be 0.  ``fact`` has a FactID
    (``Warehouse.numbered_fact``), checked for NULL, duplicates and a dense
    range.  The orphan checks are left joins from the fact to each dimension's
    distinct keys (planner broadcasts small dimensions) folded into one
    aggregate.  No id of the fact is shuffled.  With ``rejects`` the reject
    list is checked too.
    """
    parts = []
    for name, (key, _cols) in DIMENSIONS.items():
        parts.append(_dimension_checks(name, dims[name], key, []))
    date_name, date_key = DATE_DIMENSION
    parts.append(_dimension_checks(date_name, dims[date_name], date_key,
                                   ["FullDate", "Year", "Month", "MonthName"]))
    f = fact
    keys = list(FACT_KEYS)
    dim_of = {key: name for name, (key, _c) in DIMENSIONS.items()}
    dim_of[date_key] = date_name
    for k in keys:
        # distinct: a duplicate dimension key must not double the fact's rows
        f = f.join(dims[dim_of[k]].select(k).distinct().withColumn(f"_has_{k}", F.lit(True)), k, "left")
    ids = F.col("FactID")
    aggs = [F.count_if(ids.isNull()).alias("FactInvoice.FactID.null"),
            F.coalesce(F.max(ids) - F.count(F.lit(1)), F.lit(0)).alias("FactInvoice.FactID.gaps"),
            F.coalesce(F.min(ids) - 1, F.lit(0)).alias("FactInvoice.FactID.start")]
    for k in keys:
        aggs.append(F.count_if(F.col(k).isNull()).alias(f"FactInvoice.{k}.null"))
        aggs.append(F.count_if(F.col(k).isNotNull() & F.col(f"_has_{k}").isNull())
                    .alias(f"FactInvoice.{k}.orphan"))
    for col, limit in TEXT_LIMITS["FactInvoice"].items():
        aggs.append(F.count_if(F.length(col) > limit).alias(f"FactInvoice.{col}.too_long"))
    parts.append(_metrics(f.agg(*aggs), "check", "violations"))
    parts.append(_metrics(duplicate_ids(fact, "FactID").select(
        F.col("duplicates").alias("FactInvoice.FactID.duplicate")), "check", "violations"))
    if rejects is not None:
        name, limit = REJECT_ATTRIBUTE, TEXT_LIMITS["InvalidSuppliers"][REJECT_ATTRIBUTE]
        parts.append(_metrics(rejects.agg(
            F.count_if(F.col(name).isNull()).alias(f"InvalidSuppliers.{name}.null"),
            F.count_if(F.length(name) > limit).alias(f"InvalidSuppliers.{name}.too_long")),
            "check", "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
