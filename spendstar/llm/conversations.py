"""The turns of ``conversations`` in one written table, in conversation order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.llm.common import _offsets, shared_table

COLUMNS = ("conv_id", "turn", "role", "text")


def plain(conversations: DataFrame, null: str = "") -> DataFrame:
    """conv_id and turn as long, role and text with nulls read as ``null``; any
    other column is left out."""
    return conversations.select(
        *[F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")],
        *[F.coalesce(F.col(c).cast("string"), F.lit(null)).alias(c) for c in ("role", "text")])


def ordered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``at``, increasing in (conv_id, turn, role, text), nulls
    first, text by code point; equal rows are interchangeable.

    A long conversation spreads over range partitions.  Their bounds are
    sampled on a prefix of the text, so no whole text reaches the driver; the
    written table fixes ``at`` against retries.
    """
    return shared_table(
        rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
            .sortWithinPartitions("conv_id", "turn", "role", "text")
            .withColumn("at", F.monotonically_increasing_id()), name)


def numbered_turns(rows: DataFrame, name: str) -> DataFrame:
    """``ordered`` rows with a dense 0-based ``row_no`` for ``at``: each range
    partition gets the number of rows before it."""
    turns = ordered(rows, name).withColumnRenamed("at", "_at")
    parts = F.broadcast(_offsets(turns))  # one row for each partition
    return turns.join(parts, F.shiftright("_at", 33) == F.col("_part")).select(
        *COLUMNS, (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("row_no"))
