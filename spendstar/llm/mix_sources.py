"""Mixing sources to target weights with Sainte-Laguë block quotas.

Size of a document: its words.  Sources in code-point order (null last) weigh
1, 2, 3, 1, ... and share the total of all sizes; a target stops at
``max_repeats`` times its source's size and the excess is reshared by weight
until no target is above.

Each source is cut into ``shards`` streams (keyed hash of the document) and
each stream, in a keyed document order, into near-equal blocks of about
``block`` words.  The wanted blocks of all (source, shard) streams are turned
into integer quotas by highest quotients v / (2q + 1).  A stream of m blocks
with quota q takes every block q div m times and q mod m seeded blocks (a
Feistel order of block numbers) once more.  A document takes the words of the
blocks that cover it, so none exceeds ``max_repeats`` times its size.

Null and blank texts have size 0 and take nothing; an empty table gives an
empty result; rows equal in (doc_id, source, size) are interchangeable.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.llm.common import buffers, doc_slices, shared_table, word_spans
from spendstar.llm.feistel_shard import feistel

WEIGHTS = (1, 2, 3)


def targets(sizes: list[int], weights: list[float], max_repeats: int = 3) -> list[float]:
    """Shares of sum(sizes) by weight, none above max_repeats times its size."""
    total, open_, out = float(sum(sizes)), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        unit = (total - sum(out[i] for i in range(len(sizes)) if i not in open_)) \
            / sum(weights[i] for i in open_)
        over = {i for i in open_ if weights[i] * unit > max_repeats * sizes[i]}
        for i in over or open_:
            out[i] = float(max_repeats * sizes[i]) if over else weights[i] * unit
        open_ = open_ - over if over else set()
    return out


def sainte_lague(votes: list[float], most: list[int]) -> list[int]:
    """Integer quotas that sum to round(sum(votes)), by highest quotients
    v / (2q + 1), none above its ``most``.

    The first floor(v - 1/2) seats of each party are always won when the seats
    equal the votes in number, so only the last few quotients are compared.
    """
    seats = min(round(sum(votes)), sum(most))
    won = [min(m, max(0, int(v - 0.5) - 1)) for v, m in zip(votes, most)]
    heap = [(-v / (2 * q + 1), i) for i, (v, q, m) in enumerate(zip(votes, won, most)) if q < m]
    heapq.heapify(heap)
    for _ in range(seats - sum(won)):
        _, i = heapq.heappop(heap)
        won[i] += 1
        if won[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * won[i] + 1), i))
    return won


def mix(docs: DataFrame, weights: tuple = WEIGHTS, shards: int = 16, block: int = 16,
        max_repeats: int = 3, seed: int = 11) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, shard,
    quota (its stream's blocks), taken.

    The plan for the (source, shard) streams is one row each; it is computed on
    the driver because the sources are the mixture's configuration.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"), "text")
    rows = rows.mapInArrow(_sizes, "doc_id long, source string, size long") \
               .withColumn("_order", F.xxhash64(F.col("doc_id"), F.lit(seed)))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("_order"), F.lit(shards)).cast("int"))
    order = ["source", "shard", "_order", "doc_id", "size"]
    rows = shared_table(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                            .withColumn("_at", F.monotonically_increasing_id()), "mix-rows")
    # where each partition's piece of a stream begins
    pieces = (rows.groupBy("source", "shard", F.shiftright("_at", 33).alias("_part"))
                  .agg(F.sum("size").alias("_piece")).collect())
    plan, starts = _plan([(r["source"], r["shard"], r["_part"], r["_piece"]) for r in pieces],
                         weights, block, max_repeats)

    def take(batches):
        key, at = None, 0
        for batch in batches:
            src, shd = batch.column("source").to_pylist(), batch.column("shard").to_pylist()
            part = batch.column("_at").to_numpy(zero_copy_only=False) >> 33
            size = batch.column("size").to_numpy(zero_copy_only=False)
            edges = [i for i in range(len(src)) if i == 0 or (src[i], shd[i], part[i])
                     != (src[i - 1], shd[i - 1], part[i - 1])] + [len(src)]
            cols = {c: [] for c in ("source_size", "target", "quota", "taken")}
            for a, b in zip(edges, edges[1:]):
                now = (src[a], shd[a], int(part[a]))
                if now != key:  # batches of one partition come in its order
                    key, at = now, starts[now]
                source_size, target, length, blocks, quota = plan[now[:2]]
                got = _taken(size[a:b], at, length, blocks, quota, seed)
                at += int(size[a:b].sum())
                for c, v in (("source_size", source_size), ("target", target), ("quota", quota)):
                    cols[c] += [v] * (b - a)
                cols["taken"] += got.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), batch.column("size"),
                 pa.array(cols["source_size"], pa.int64()), pa.array(cols["target"], pa.float64()),
                 batch.column("shard"), pa.array(cols["quota"], pa.int64()),
                 pa.array(cols["taken"], pa.int64())],
                names=["doc_id", "source", "size", "source_size", "target", "shard", "quota", "taken"])

    return rows.mapInArrow(take, "doc_id long, source string, size long, source_size long, "
                                 "target double, shard int, quota long, taken long")


def repeated(docs: DataFrame, seed: int = 11, **options) -> DataFrame:
    """The rows of ``docs`` in whole copies: the words a document takes divided by
    its size, rounded up or down by a keyed draw with that mean (so sources keep
    their targets on average; 0 to ``max_repeats`` copies).  Rows without words
    stay once.  Rows that repeat (doc_id, source) get the most of their draws."""
    taken = mix(docs.select("doc_id", "source", "text"), seed=seed, **options)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed), F.lit("copies")), F.lit(1 << 20)) / F.lit(1 << 20)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(
        F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + draw).cast("int"))
    share = (taken.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"))
                  .agg(F.max(copies).alias("_copies")).where(F.col("_copies") > 0))
    key = (F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
           & F.col("source").cast("string").eqNullSafe(F.col("_source")))
    again = F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_again")
    return docs.join(share, key).select(*docs.columns, again).drop("_again")


def _sizes(batches):
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        counts = np.zeros(batch.num_rows, dtype=np.int64)
        for i, j in doc_slices(offsets):
            part = data[offsets[i]:offsets[j]]
            counts[i:j] = np.diff(word_spans(part, offsets[i:j + 1] - offsets[i])[2])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"),
                                          pa.array(counts)], names=["doc_id", "source", "size"])


def _plan(pieces: list, weights: tuple, block: int, max_repeats: int):
    """{(source, shard): (source size, target, words, blocks, quota)} and
    {(source, shard, partition): words before it in the stream}."""
    pieces = sorted(pieces, key=lambda p: (p[0] is None, (p[0] or "").encode(), p[1], p[2]))
    sources = list(dict.fromkeys(p[0] for p in pieces))
    total: dict = {s: 0 for s in sources}
    stream: dict = {}
    starts: dict = {}
    for s, h, part, n in pieces:
        starts[s, h, part] = stream.get((s, h), 0)
        stream[s, h] = starts[s, h, part] + n
        total[s] += n
    goal = dict(zip(sources, targets([total[s] for s in sources],
                                     [weights[i % len(weights)] for i in range(len(sources))],
                                     max_repeats) if sum(total.values()) else [0.0] * len(sources)))
    blocks = {k: max(1, round(n / block)) if n else 0 for k, n in stream.items()}
    votes = [goal[s] / total[s] * blocks[s, h] if total[s] else 0.0 for s, h in stream]
    quotas = sainte_lague(votes, [max_repeats * blocks[k] for k in stream])
    plan = {(s, h): (total[s], goal[s], stream[s, h], blocks[s, h], q)
            for (s, h), q in zip(stream, quotas)}
    return plan, starts


def _taken(size: np.ndarray, start: int, length: int, blocks: int, quota: int,
           seed: int) -> np.ndarray:
    """Words taken of consecutive documents of one stream that begin at ``start``.
    Block i covers the words [i * length div blocks, (i + 1) * length div blocks)."""
    if not blocks:
        return np.zeros(len(size), dtype=np.int64)
    every, extra = divmod(quota, blocks)
    ends = start + np.cumsum(size)
    lo, hi = int(start), int(ends[-1])
    first, last = lo * blocks // length, min(blocks - 1, max(0, hi * blocks // length))
    index = np.arange(max(0, first - 1), min(blocks, last + 2), dtype=np.int64)
    edge = index * length // blocks if length * blocks < 2**62 else \
        np.array([int(i) * length // blocks for i in index], dtype=np.int64)
    edge = np.append(edge, (int(index[-1]) + 1) * length // blocks)
    chosen = (feistel(index, blocks, seed) < extra).astype(np.int64)
    # chosen words before each block edge, then before each document's end by interpolation
    before = np.concatenate([[0], np.cumsum(chosen * np.diff(edge))])
    cuts = np.concatenate([[lo], ends])
    slot = np.clip(np.searchsorted(edge, cuts, side="right") - 1, 0, len(index) - 1)
    upto = before[slot] + chosen[slot] * (cuts - edge[slot])
    return every * size + np.diff(upto)
