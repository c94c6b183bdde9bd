"""Quality scores by a factorisation machine.

Features of a text, all from the text alone: distinct hashed words (each worth
1 / sqrt(their number)) and structure statistics in fixed bins (each worth 1).
The score is sigmoid(w0 + sum w x + 1/2 sum_f ((sum v x)^2 - sum v^2 x^2)), the
sum-of-squares form of all pairwise interactions, linear in the features.

The model is fitted on at most ``sample`` labelled documents (a documented
bound, chosen by a keyed hash) whose crc32(doc_id) mod 5 is not 0; every
document is scored.  Rows without id, text or label are not learned from; null
and empty texts are scored from their statistics alone.  Without two classes
among the labels the score is their smoothed mean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.llm.common import buffers, doc_slices, lowered, span_hashes, word_spans

WORD_BITS = 14
RANK = 8
BINS = 16
SAMPLE = 4_000
THRESHOLD = 0.3

_CLASS = np.zeros((5, 256), dtype=np.int64)  # upper, digit, mark, line end, other letters
_CLASS[0, 65:91] = 1
_CLASS[1, 48:58] = 1
for _lo, _hi in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _CLASS[2, _lo:_hi] = 1
_CLASS[3, 10] = 1
_CLASS[4, 128:] = 1
STATS = 12
FEATURES = (1 << WORD_BITS) + STATS * BINS


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def features(data: np.ndarray, offsets: np.ndarray):
    """(index, value, row offsets): sparse features of each text."""
    n = len(offsets) - 1
    data = np.asarray(data)
    starts, ends, at = word_spans(data, offsets)
    hashes = span_hashes(lowered(data), starts, ends)
    counts = np.diff(at)
    size = np.diff(offsets)
    sums = [np.concatenate([[0], np.cumsum(c[data])]) for c in _CLASS]
    upper, digit, mark, lines, wide = [s[offsets[1:]] - s[offsets[:-1]] for s in sums]
    lengths = np.concatenate([[0], np.cumsum(ends - starts)])
    letters = lengths[at[1:]] - lengths[at[:-1]]
    # words that end in a mark, begin with a capital, or repeat the word before
    last = np.concatenate([[0], np.cumsum(_CLASS[2][data[ends - 1]])]) if len(ends) else np.zeros(1, int)
    cap = np.concatenate([[0], np.cumsum(_CLASS[0][data[starts]])]) if len(starts) else np.zeros(1, int)
    # one entry more than words: a text without words may stand last
    same = np.zeros(len(hashes) + 2, dtype=np.int64)
    same[2:-1] = np.cumsum(hashes[1:] == hashes[:-1])
    same[-1] = same[-2]
    words = np.maximum(counts, 1)
    index, value, to = [], [], [0]
    distinct = np.zeros(n, dtype=np.int64)
    kept = []
    for i in range(n):
        own = np.unique(hashes[at[i]:at[i + 1]])
        distinct[i] = len(own)
        kept.append(np.unique(own >> np.uint64(64 - WORD_BITS)).astype(np.int32))
    chars = np.maximum(size, 1)
    stats = np.stack([
        _share(upper / chars), _share(digit / chars), _share(mark / chars), _share(wide / chars),
        _share((last[at[1:]] - last[at[:-1]]) / words), _share((cap[at[1:]] - cap[at[:-1]]) / words),
        _share((same[np.maximum(at[1:], at[:-1] + 1)] - same[at[:-1] + 1]) / words
               if len(hashes) else np.zeros(n)),
        _share(1 - distinct / words), _log(letters / words * 8), _log(size), _log(counts),
        _log(lines * 64 / words * 4)], axis=1)
    base = (1 << WORD_BITS) + np.arange(STATS, dtype=np.int32) * BINS
    for i in range(n):
        index += [kept[i], (base + stats[i]).astype(np.int32)]
        value += [np.full(len(kept[i]), 1 / np.sqrt(max(1, len(kept[i]))), dtype=np.float32),
                  np.ones(STATS, dtype=np.float32)]
        to.append(to[-1] + len(kept[i]) + STATS)
    return (np.concatenate(index) if n else np.zeros(0, np.int32),
            np.concatenate(value) if n else np.zeros(0, np.float32), np.array(to))


def _share(x: np.ndarray) -> np.ndarray:
    """Bins of a share in 0..1, finer near 0."""
    return np.clip(np.sqrt(np.clip(x, 0, 1)) * BINS, 0, BINS - 1).astype(np.int32)


def _log(x: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(x, 0) + 1), 0, BINS - 1).astype(np.int32)


def _margin(model: dict, index: np.ndarray, value: np.ndarray, to: np.ndarray):
    """(margins, sum v x of each row)."""
    if len(to) < 2:
        return np.zeros(0), np.zeros((0, RANK))
    linear = np.add.reduceat(model["w"][index] * value, to[:-1])
    vx = model["v"][index] * value[:, None]
    sums = np.add.reduceat(vx, to[:-1], axis=0)
    squares = np.add.reduceat(np.einsum("ij,ij->i", vx, vx), to[:-1])
    return model["w0"] + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def fit(index: np.ndarray, value: np.ndarray, to: np.ndarray, y: np.ndarray,
        rounds: int = 40, rate: float = 0.05, decay: float = 1e-4, seed: int = 5) -> dict:
    """Full-batch Adam on the log loss; deterministic for the same rows."""
    model = {"w0": np.zeros(1), "w": np.zeros(FEATURES),
             "v": np.random.default_rng(seed).normal(0, 0.02, (FEATURES, RANK))}
    mean = (y.sum() + 1) / (len(y) + 2)
    model["w0"][0] = np.log(mean / (1 - mean))
    if len(y) == 0 or y.min() == y.max():
        model["v"][:] = 0
        return model
    row = np.repeat(np.arange(len(y)), np.diff(to))
    moments = {k: [np.zeros_like(a), np.zeros_like(a)] for k, a in model.items()}
    for step in range(1, rounds + 1):
        margin, sums = _margin(model, index, value, to)
        g = (1 / (1 + np.exp(-margin)) - y) / len(y)
        gx = g[row] * value
        grads = {"w0": np.array([g.sum()]),
                 "w": np.bincount(index, weights=gx, minlength=FEATURES) + decay * model["w"]}
        v = np.empty_like(model["v"])
        for f in range(RANK):
            own = gx * (sums[row, f] - model["v"][index, f] * value)
            v[:, f] = np.bincount(index, weights=own, minlength=FEATURES)
        grads["v"] = v + decay * model["v"]
        for k, a in model.items():
            m, s = moments[k]
            m *= 0.9
            m += 0.1 * grads[k]
            s *= 0.999
            s += 0.001 * grads[k] ** 2
            a -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return model


def sampled_labels(labels: DataFrame, column: str, sample: int) -> DataFrame:
    """At most ``sample`` (doc_id, y) of the rows learned from, by a keyed hash.
    A document labelled twice counts with its larger label."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col(column).cast("int").alias("y"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out())
    return (rows.groupBy("doc_id").agg(F.max("y").alias("y"))
                .orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(sample))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    picked = F.broadcast(sampled_labels(labels, "quality", sample))  # at most ``sample`` rows
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                .where(F.col("text").isNotNull()).join(picked, "doc_id")
                # one text an id, the smallest: the sample bounds rows, not only ids
                .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y")))

    def sparse(batches):
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for i, j in doc_slices(offsets):
                index, value, to = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), batch.column("y").slice(i, j - i),
                     pa.array([index[a:b].tobytes() for a, b in zip(to, to[1:])], pa.binary()),
                     pa.array([value[a] if b > a else 0.0 for a, b in zip(to, to[1:])], pa.float32())],
                    names=["doc_id", "y", "features", "unit"])

    got = rows.mapInArrow(sparse, "doc_id long, y int, features binary, unit float").toPandas()
    got = got.sort_values(["doc_id", "y", "unit"], kind="stable").reset_index(drop=True)
    index = [np.frombuffer(b, np.int32) for b in got["features"]]
    to = np.concatenate([[0], np.cumsum([len(x) for x in index], dtype=np.int64)]).astype(np.int64)
    value = [np.where(x < (1 << WORD_BITS), u, 1.0) for x, u in zip(index, got["unit"])]
    return fit(np.concatenate(index) if index else np.zeros(0, np.int32),
               np.concatenate(value) if value else np.zeros(0), to, got["y"].to_numpy(dtype=float))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = train(docs, labels, sample)
    model = {k: a.astype(np.float32) for k, a in model.items()}

    def run(batches):
        for batch in batches:
            out = score_arrow(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)],
                                             names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
               .mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def score_arrow(model: dict, column: pa.Array) -> np.ndarray:
    data, offsets = buffers(column)
    out = np.zeros(len(offsets) - 1)
    for i, j in doc_slices(offsets, 1 << 20):
        part = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        margin, _ = _margin(model, *part)
        out[i:j] = 1 / (1 + np.exp(-margin.astype(np.float64)))
    return out


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.3, in its own columns."""
    model = {k: a.astype(np.float32) for k, a in train(docs, labels, sample).items()}

    def run(batches):
        for batch in batches:
            keep = score_arrow(model, batch.column("text")) >= THRESHOLD
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
