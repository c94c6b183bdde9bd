"""A training-data pipeline over ``documents``: five stages, each one of the
operators in ``spendstar.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's ``docs``.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.llm import fm_quality, minhash_dedup, mix_sources, pii_sanitise, pow2_pack
from spendstar.llm.common import shared_table, table
from spendstar.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score below 0.3) go."""
    return fm_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest doc_id."""
    return minhash_dedup.keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and the terms that disclose it, are replaced in the texts."""
    return pii_sanitise.sanitise(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document in as many whole copies as the mix takes of its words (0 to
    3, a fraction by a keyed draw); documents without words stay once."""
    return mix_sources.repeated(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two length, as in ``op3``."""
    return pow2_pack.pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mixing),
          ("packing", packing)]

#: Signatures, models and tokens are not SQL: tests/llm holds the operators
#: against brute force, and the stages' columns, order and effects.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; ids are digested to a checksum."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                       "sequence_id", "offset")
