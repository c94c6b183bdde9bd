"""Sharding by a keyed permutation of global row numbers.

Rows are numbered 0..n-1 in the order of (doc_id, text checksum, size); a
balanced Feistel network over the next even number of bits, cycle-walked back
into 0..n-1, permutes the numbers.  Position p goes to shard p mod S at slot
p div S, so shard and slot are computable from the row number, the row count
and the seed alone; shard sizes differ by one row at most (law ``rows``).

Null ids sort first; rows equal in every ordering column are interchangeable.
Null texts have size 1 and the checksum of the empty text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.llm.common import numbered

ROUNDS = 4


def feistel(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A permutation of 0..n-1 applied to ``x``; same result for same (n, seed)."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = np.random.default_rng([seed, 77]).integers(1, 2**63, ROUNDS, dtype=np.uint64)

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> shift, v & mask
        for key in keys:
            f = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f ^ (f >> np.uint64(29))) & mask)
        return (left << shift) | right

    out = once(np.asarray(x, dtype=np.uint64))
    walk = np.flatnonzero(out >= np.uint64(n))
    while len(walk):  # each step permutes 0..4^half-1, so the walk comes back below n
        out[walk] = once(out[walk])
        walk = walk[out[walk] >= np.uint64(n)]
    return out.astype(np.int64)


def shard(docs: DataFrame, shards: int = 16, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, row_no, position, shard, slot."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    rows = numbered(rows, ["doc_id", "text_crc32", "size"], "shard-rows")
    n = rows.count()

    @F.pandas_udf("long")
    def position(row_no: pd.Series) -> pd.Series:
        return pd.Series(feistel(row_no.to_numpy(), n, seed))

    return (rows.withColumn("position", position("row_no"))
                .withColumn("shard", F.pmod("position", F.lit(shards)).cast("int"))
                .withColumn("slot", F.expr(f"position div {int(shards)}")))
