"""Materialise and publish tables as Parquet.

``materialize`` cuts lineage with a written table in the shared scratch
folder (``spark.checkpoint.dir``): the result survives executor loss, and
the read-back scan gets column pruning, filter pushdown and real size
statistics (which is what lets the planner decide broadcasts on evidence).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.session import scratch_path

# A lookup table of at most this size (the planner's: the bytes of its files) is
# broadcast, also in a session with a lower threshold: the rows that look it up
# are wide and many.
LOOKUP_BYTES = 10 << 20


def size_in_bytes(df: DataFrame) -> int:
    """The planner's size of a frame; of a stored table, the bytes of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup(df: DataFrame) -> DataFrame:
    """``df`` as the small side of a join: marked for broadcast where it is known
    to hold at most ``LOOKUP_BYTES``, else (or in a session with broadcasts
    switched off) left to the planner."""
    off = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    return df if off or size_in_bytes(df) > LOOKUP_BYTES else F.broadcast(df)


def materialize(df: DataFrame, name: str, path: str | None = None,
                partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet (a new folder each call) and read it back."""
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    # static: a rebuild replaces the whole table, whatever the session's mode; one
    # file a task, as the fact's numbering by file expects
    writer = (df.write.mode("overwrite").option("partitionOverwriteMode", "static")
                .option("maxRecordsPerFile", 0))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    # The schema is known: passing it skips the footer-reading inference job.
    return spark.read.schema(df.schema).parquet(target)


def remove(spark, path: str) -> None:
    """Delete a scratch table that no later step reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
