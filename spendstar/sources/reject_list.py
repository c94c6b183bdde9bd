"""Reject list of supplier names, read from XML.

Shape: ``<Suppliers><Supplier SupplierName="..."/>...</Suppliers>``.

Each file is one document, parsed whole by Spark's XPath functions, so the
names are those of the root's own children (a ``Supplier`` deeper in the
document is not one) and well-formedness is the XML parser's judgement, with
its line, column and reason in the error.  A list may be many files; they are
parsed in parallel, and one file is held by one task.

``repair=True`` escapes bare ampersands first.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.constants import (
    REJECT_ATTRIBUTE,
    REJECT_ROOT_TAG,
    REJECT_ROW_TAG,
)
from spendstar.sources.files import listed

# An ampersand that does not start a character or entity reference.
BARE_AMPERSAND = r"&(?!(amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)"
DECLARED = r"""^<\?xml[^>]*encoding=["']([A-Za-z0-9._-]+)["']"""
_ROW = f"/{REJECT_ROOT_TAG}/{REJECT_ROW_TAG}"


class RejectListError(ValueError):
    """The reject-list XML is not well formed, or not a list of named suppliers."""


def _text(content: Column) -> Column:
    """The document's text, by its byte-order mark, else its declaration, else UTF-8."""
    start = F.hex(F.substring(content, 1, 2))
    declared = F.upper(F.regexp_extract(F.decode(F.substring(content, 1, 200), "ISO-8859-1"), DECLARED, 1))
    charset = F.when(start == "FFFE", "UTF-16LE").when(start == "FEFF", "UTF-16BE") \
               .when(declared.isin("", "UTF-16"), "UTF-8").otherwise(declared)
    return F.regexp_replace(F.call_function("decode", content, charset), "^﻿", "")


def documents(spark: SparkSession, paths: str | Iterable[str], repair: bool = False) -> DataFrame:
    """[file, document]: each file's whole text, one row a file."""
    text = _text(F.col("content"))
    if repair:
        text = F.regexp_replace(text, BARE_AMPERSAND, "&amp;")
    return (spark.read.format("binaryFile").load(listed(paths))
            .select(F.col("path").alias("file"), text.alias("document")))


def _names(docs: DataFrame) -> DataFrame:
    names = F.xpath("document", F.lit(f"{_ROW}/@{REJECT_ATTRIBUTE}"))
    return docs.select(F.explode(names).alias(REJECT_ATTRIBUTE))


def _reason(error: Exception) -> str:
    """The XML parser's own words: line, column and reason."""
    found = re.search(r"lineNumber: (\d+); columnNumber: (\d+); ([^\n]+)", str(error))
    if found:
        return f"line {found[1]}, column {found[2]}: {found[3]}"
    lines = str(error).strip().splitlines()
    return lines[0][:300] if lines else type(error).__name__


def check_documents(docs: DataFrame) -> None:
    """Raise unless every document is well formed, has the list's root, and
    names every supplier."""
    facts = F.xpath_string("document", F.lit(
        f"concat(count(/{REJECT_ROOT_TAG}), ' ', count({_ROW}[not(@{REJECT_ATTRIBUTE})]))"))
    checked = docs.select("file", F.split(facts, " ").alias("_f")).select(
        "file", F.coalesce(F.col("_f")[0].cast("int"), F.lit(0)).alias("roots"),
        F.col("_f")[1].cast("bigint").alias("nameless"))
    try:
        bad = checked.where("roots != 1 OR nameless > 0").limit(5).collect()
    except Exception as e:  # the parser's error, thrown in a task
        raise RejectListError("XML parsing failed (escape bare '&' as '&amp;' or use repair=True): "
                              + _reason(e)) from e
    rootless = [r.file for r in bad if r.roots != 1]
    if rootless:
        raise RejectListError(f"XML parsing failed: the root is not <{REJECT_ROOT_TAG}> in {', '.join(rootless)}")
    if bad:
        raise RejectListError("; ".join(
            f"{r.nameless} <{REJECT_ROW_TAG}> without {REJECT_ATTRIBUTE} in {r.file}" for r in bad))


def read_reject_list(spark: SparkSession, paths: str | Iterable[str],
                     repair: bool = False, validate: bool = True) -> DataFrame:
    """Supplier names to reject, one row each (column ``SupplierName``).

    A malformed document, another root, or a supplier without a name raises
    :class:`RejectListError` at read time, before a load starts, unless
    ``validate=False``.
    """
    docs = documents(spark, paths, repair)
    if validate:
        check_documents(docs)
    return _names(docs)


def write_reject_list(df: DataFrame, path: str, column: str = REJECT_ATTRIBUTE,
                      mode: str = "overwrite") -> None:
    """Write names as reject-list XML (one document per output file)."""
    (df.select(F.col(column).alias(f"_{REJECT_ATTRIBUTE}")).write.mode(mode)
       .option("rootTag", REJECT_ROOT_TAG)
       .option("rowTag", REJECT_ROW_TAG)
       .option("attributePrefix", "_")
       .xml(path))
