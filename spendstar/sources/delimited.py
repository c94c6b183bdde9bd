"""Tolerant delimited-text staging load (and the matching writer).

Every field is read as text, so nothing in the file can fail the load:
bad dates and amounts are dealt with later, short or long rows are kept and
flagged in ``_corrupt_record``.  Quotes are data, not syntax.  Each file's
first line is a header and is skipped.  Empty fields load as NULL.

Records end at the file's own line ending, in the file's own encoding: both
are told from its first bytes (``sources.files``) unless given, so UTF-16
exports split right and a lone carriage return inside a field stays data.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendstar.constants import SPEND_COLUMNS, SPEND_SCHEMA
from spendstar.sources.files import listed, sniff

# A compressed file is read by one task: it holds this many rows at most.
ROWS_PER_PACKED_FILE = 250_000
CORRUPT_COLUMN = "_corrupt_record"
SOURCE_COLUMN = "source_file"


def spend_options(sep: str, encoding: str, line_sep: str, header: bool) -> dict:
    """The reader options of a spend file, for batch and stream."""
    return {"sep": sep, "header": header, "encoding": encoding, "lineSep": line_sep,
            "quote": "",  # quotes are literal characters
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def spend_schema(lineage: bool) -> T.StructType:
    extra = [T.StructField(CORRUPT_COLUMN, T.StringType(), True)] if lineage else []
    return T.StructType(list(SPEND_SCHEMA.fields) + extra)


def read_spend(spark: SparkSession, paths: str | Iterable[str], sep: str = "\t",
               encoding: str | None = None, header: bool = True,
               lineage: bool = True, line_sep: str | None = None) -> DataFrame:
    """Read one or many spend files into the all-text staging shape.

    ``paths`` may be a file, a folder, a glob or a list of them; files of one
    encoding and line ending are one splittable scan, and the scans are
    unioned.  With ``lineage`` the result carries ``source_file`` and
    ``_corrupt_record`` (the raw line when the field count is wrong).
    """
    schema = spend_schema(lineage)
    kinds = sniff(spark, paths, encoding, line_sep)
    if not kinds:
        spark.read.text(listed(paths)).schema  # a path that does not exist is an error
        kinds = {(encoding or "UTF-8", line_sep or "\n"): []}
    scans = []
    for (name, ending), files in sorted(kinds.items()):
        if not files:
            scans.append(spark.createDataFrame([], schema).withColumn(SOURCE_COLUMN, F.lit("")))
            continue
        scan = spark.read.schema(schema).options(**spend_options(sep, name, ending, header)).csv(files)
        if not header:  # with a header the mark goes with it
            first = SPEND_COLUMNS[0]
            scan = scan.withColumn(first, F.regexp_replace(first, "^﻿", ""))
        scans.append(scan.withColumn(SOURCE_COLUMN, F.input_file_name()))
    df = reduce(DataFrame.unionByName, scans)
    return df if lineage else df.drop(SOURCE_COLUMN)


def _writable(name: str, sep: str) -> Column:
    """The value, or an error where it would shift columns or rows."""
    broken = F.col(name).contains(sep) | F.col(name).rlike("[\r\n]")
    message = F.concat(F.lit(f"{name} holds a field or line separator: "), F.col(name))
    return F.when(broken, F.raise_error(message).cast("string")).otherwise(F.col(name)).alias(name)


def packed(compression: str | None) -> dict:
    """The writer options of compressed text; none without a codec."""
    return {"compression": compression, "maxRecordsPerFile": ROWS_PER_PACKED_FILE} if compression else {}


def write_spend(df: DataFrame, path: str, sep: str = "\t", header: bool = True,
                mode: str = "overwrite", encoding: str = "UTF-8", line_sep: str = "\n",
                compression: str | None = None) -> None:
    """Write staging-shaped rows as delimited text that ``read_spend`` reads back.

    Values are written verbatim: no quoting, no whitespace trimming; a value
    that holds the separator or a line break is an error.  Empty and NULL
    fields both become empty fields (and load back as NULL).  With ``compression``
    (``gzip``) the text is packed, in files of ``ROWS_PER_PACKED_FILE`` rows at most.
    """
    (df.select(*[_writable(c, sep) for c in SPEND_COLUMNS]).write.mode(mode)
       .option("sep", sep)
       .option("header", header)
       .option("quote", "")
       .option("emptyValue", "")
       .option("encoding", encoding)
       .option("lineSep", line_sep)
       .option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False)
       .options(**packed(compression))
       .csv(path))
