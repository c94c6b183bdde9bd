"""Exact top-k inner-product search with one KD-tree per shard.

Components become floor(256 * x).  Vectors are dealt by a hash of their id into
shards of about ``SHARD`` vectors, queries into blocks of about ``BLOCK``.  A
tree splits at the median of the widest dimension and keeps tight boxes; a
query visits nodes best first by the largest inner product its box allows and
stops below its k-th score.  Each query first searches its own vector's shard;
the k-th score found there bounds its search of every other shard.

Vectors that are null or hold null or non-finite components, and rows without
vec_id, take no part.  Rows that repeat a vec_id count once (the smallest
vector).  Vectors of different lengths are padded with zeros.  Ties go to the
smaller vec_id; fewer candidates than k give fewer rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD, BLOCK, LEAF = 4096, 256, 64
_FOUND = "query_id long, vec_id long, score long"


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, as integers."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.transform(x, lambda c: F.floor(c * 256).cast("long")).alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


class KdTree:
    """Nodes in arrays: tight boxes, children (-1 at leaves), rows, smallest id."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.ids, self.points = ids, points
        self.lo, self.hi, self.left, self.right, self.rows = [], [], [], [], []
        if len(ids):
            self._grow(np.arange(len(ids)))
            self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _grow(self, rows: np.ndarray) -> int:
        node = len(self.lo)
        part = self.points[rows]
        lo, hi = part.min(axis=0), part.max(axis=0)
        self.lo.append(lo)
        self.hi.append(hi)
        self.left.append(-1)
        self.right.append(-1)
        self.rows.append(rows)
        if len(rows) > LEAF:
            half = len(rows) // 2
            order = np.argpartition(part[:, int(np.argmax(hi - lo))], half)
            self.rows[node] = None
            self.left[node] = self._grow(rows[order[:half]])
            self.right[node] = self._grow(rows[order[half:]])
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(queries, nodes): the largest inner product that a node's box allows."""
        return np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T

    def search(self, own: int, query: np.ndarray, bounds: np.ndarray, k: int, least: float):
        """The k best (score, id) of at least ``least``, by score then smaller id."""
        best: list = []  # a heap with the worst on top
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            rows = self.rows[node]
            scores = self.points[rows] @ query
            for r in np.flatnonzero(scores >= least):
                item = (scores[r], -int(self.ids[rows[r]]))
                if -item[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                least = max(least, best[0][0])
        return [(int(s), -i) for s, i in best]


def _matrix(rows: list, width: int) -> np.ndarray:
    """float64 where every inner product is exact in it, else int64."""
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _search(k: int):
    def run(_, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        width = max(max(map(len, vectors["v"])), max(map(len, queries["qv"])))
        points, wanted = _matrix(list(vectors["v"]), width), _matrix(list(queries["qv"]), width)
        if float(np.abs(points).max(initial=0)) * float(np.abs(wanted).max(initial=0)) * width < 2**52:
            points, wanted = points.astype(np.float64), wanted.astype(np.float64)
        tree = KdTree(vectors["vec_id"].to_numpy(), points)
        bounds = tree.bounds(wanted)
        out = [(q, i, s) for n, (q, least) in enumerate(zip(queries["query_id"], queries["least"]))
               for s, i in tree.search(int(q), wanted[n], bounds[n], k,
                                       -np.inf if pd.isna(least) else least)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score for the vectors whose id ``every`` divides."""
    from spendstar.llm.common import shared_table
    rows = shared_table(prepared(vectors), "kd-vectors")
    n, q = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-q // BLOCK))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    queries = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("qv"), F.col("shard").alias("qshard"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("qblock"))
    dealt = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def pass_(asked: DataFrame) -> DataFrame:
        return (dealt.groupBy("shard", "block").cogroup(asked.groupBy("qshard", "qblock"))
                     .applyInPandas(_search(k), _FOUND))

    home = shared_table(pass_(queries.withColumn("least", F.lit(None).cast("double"))), "kd-home")
    kth = (_best(home, k).groupBy("query_id")
           .agg(F.when(F.count("*") == k, F.min("score")).cast("double").alias("least")))
    far = (queries.join(kth, "query_id", "left").withColumnRenamed("qshard", "own")
                  .withColumn("qshard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
                  .where("qshard <> own").drop("own"))
    return _best(home.union(pass_(far)), k).select("query_id", F.col("rank").cast("int").alias("rank"),
                                                   "vec_id", "score")
