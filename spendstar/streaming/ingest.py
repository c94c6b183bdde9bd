"""Incremental staging load with Structured Streaming.

The batch staging load reads every spend file each time.  When files keep
arriving in a folder, the same tolerant reader can run as a file-source
stream: each file is read once, appended to a Parquet staging table, and
the stream's checkpoint (on shared storage) remembers which files are done,
so a restarted or retried job neither skips nor repeats a file.  With
``availableNow`` the job processes what is there and stops, which suits a
scheduled load; the warehouse is then rebuilt from the staging table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spendstar.sources.delimited import SOURCE_COLUMN, spend_options, spend_schema
from spendstar.sources.files import sniff


def stream_spend(spark: SparkSession, folder: str, sep: str = "\t", encoding: str | None = None,
                 max_files_per_trigger: int | None = None, line_sep: str | None = None) -> DataFrame:
    """Streaming staging rows from the spend files that arrive in ``folder``.

    Same options as :func:`spendstar.sources.delimited.read_spend`: all
    text, header skipped per file, quotes literal, malformed rows kept and
    flagged, plus ``source_file``.  A stream reads one kind of file: encoding
    and line ending, where not given, are those of the files that are in the
    folder when it starts (UTF-8 and line feed if there is none), and files of
    several kinds are an error.
    """
    if not (encoding and line_sep):
        kinds = sorted(sniff(spark, folder, encoding, line_sep))
        if len(kinds) > 1:
            raise ValueError(f"files of several encodings or line endings in {folder}: {kinds}")
        encoding, line_sep = kinds[0] if kinds else (encoding or "UTF-8", line_sep or "\n")
    reader = spark.readStream.schema(spend_schema(lineage=True)).options(
        **spend_options(sep, encoding, line_sep, header=True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder).withColumn(SOURCE_COLUMN, F.input_file_name())


def ingest_spend(spark: SparkSession, folder: str, staging_path: str,
                 checkpoint: str | None = None, sep: str = "\t",
                 available_now: bool = True, encoding: str | None = None,
                 line_sep: str | None = None) -> StreamingQuery:
    """Append new spend files from ``folder`` to the Parquet table at ``staging_path``.

    The checkpoint defaults to ``<staging_path>.checkpoint``: it belongs to the
    table, so every later run, in any application, finds it.
    Returns the started query; with ``available_now`` call
    ``awaitTermination()`` to wait for the files present at start.
    """
    ckpt = checkpoint or staging_path.rstrip("/") + ".checkpoint"
    writer = (stream_spend(spark, folder, sep=sep, encoding=encoding, line_sep=line_sep).writeStream
              .format("parquet")
              .option("path", staging_path)
              .option("checkpointLocation", ckpt)
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
