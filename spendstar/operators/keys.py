"""Surrogate keys.

``dense_keys`` gives 1..n in the sort order of the natural columns (NULLs
first), optionally restarting per group, computed in parallel:
range-partition and sort the rows, write them with their partition index
and position (fixing the sampled range bounds, so a retried task cannot
shift them), count rows per partition and group, and add each partition's
running offset.  Only the per-partition counts (one small row per partition
and group) are combined on a single task, and that table is broadcast; its
size is bounded by partitions x groups, not by the data.

``row_ids`` gives unique, increasing (not dense) ids with no shuffle at
all, for tables too large to sort just for numbering (the fact).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendstar.session import scratch_path
from spendstar.sources.tables import materialize, remove


def dense_keys(df: DataFrame, order: Sequence[str], key: str, by: str | None = None,
               partitions: int | None = None, name: str = "keys",
               partition_by: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Add ``key`` = 1..n (int) in ascending order of ``order`` (NULLs first).

    With ``by`` the numbering restarts at 1 for each value of that column.
    Rows must be distinct on (``by``, ``order``) for the keys to be a total
    order.  The result is materialised at ``path`` or in the shared scratch
    folder (``partition_by`` lays it out in sub-folders).
    """
    groups = [by] if by else []
    sort = [F.col(c).asc_nulls_first() for c in groups + list(order)]
    # Without an explicit count AQE may merge small neighbouring ranges; it
    # merges in order, so partition index order is still key order.
    parts = [partitions] if partitions else []
    ranged = (df.repartitionByRange(*parts, *sort)
                .sortWithinPartitions(*sort)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()))
    spark = df.sparkSession
    scratch = scratch_path(spark, f"{name}-ranged")
    staged = materialize(ranged, f"{name}-ranged", scratch)
    counts = staged.groupBy("_pid", *groups).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    # One row per partition and group: this window is bounded by that count.
    before = (Window.partitionBy(*groups) if groups else Window).orderBy("_pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", *groups, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    keyed = staged.join(F.broadcast(offsets), ["_pid", *groups]).select(
        (F.col("_off") + F.col("_pos") - F.col("_first") + 1).cast("int").alias(key),
        *df.columns)
    out = materialize(keyed, name, path=path, partition_by=partition_by)
    remove(spark, scratch)  # only the write above reads it
    return out


def row_ids(df: DataFrame, key: str) -> DataFrame:
    """Add a unique, increasing BIGINT id without a shuffle (not dense)."""
    return df.select(F.monotonically_increasing_id().alias(key), *df.columns)
