"""Helpers shared by the operators: input tables, tables written to the shared
folder, dense row numbers, and vectorised word hashing over Arrow strings."""

from __future__ import annotations

import uuid
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.session import checkpoint_dir

#: A word is a run of anything but these ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20250101).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_CHUNK, _LONG = 1 << 20, 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder of ``spark.checkpoint.dir`` and
    reread: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list, name: str, col: str = "row_no") -> DataFrame:
    """``df`` with a dense 0-based ``col`` in the total order ``order``.

    Rows are range-partitioned and sorted, written once, and each partition
    gets the number of rows before it.  The window runs over one row for each
    partition, never over the data.
    """
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn("_at", F.monotonically_increasing_id()))
    ranged = shared_table(ranged, name)
    return ranged.join(F.broadcast(_offsets(ranged)), F.shiftright("_at", 33) == F.col("_part")) \
                 .withColumn(col, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))) \
                 .drop("_at", "_part", "_before", "_rows")


def _offsets(ranged: DataFrame) -> DataFrame:
    """One row for each partition of a range-sorted table: the rows before it."""
    from pyspark.sql import Window
    parts = ranged.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    return parts.withColumn("_before", F.coalesce(before, F.lit(0)))


# --- Arrow strings as one byte buffer ---------------------------------------

def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def doc_slices(offsets: np.ndarray, most: int = 4 << 20):
    """(first, last) row ranges of at most ``most`` bytes, a longer text alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of words (bytes that are no ASCII blank) and each text's
    word range; a text's edge ends a word."""
    body = ~_SPACE[data]
    start, stop = body.copy(), body.copy()
    start[1:] &= ~body[:-1]
    stop[:-1] &= ~body[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[heads] = body[heads]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    stop[tails] = body[tails]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_POW: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) < n:
        size = max(n, _CHUNK + 4096)
        base = np.full(size, _BASE, dtype=np.uint64)
        back = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        base[0] = back[0] = 1
        _POW[:] = [np.cumprod(base), np.cumprod(back)]
    return _POW[0], _POW[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each span (ascending, not overlapping).

    Spans below ``_LONG`` bytes are hashed together, as polynomials modulo 2^64;
    longer ones, of which some pairs would collide whatever the base, one by one.
    """
    out, i, n = np.empty(len(starts), dtype=np.uint64), 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _CHUNK, side="right")))
        base = starts[i]
        part = data[base:ends[j - 1]]
        up, down = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * up[:len(part)], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    for k in np.flatnonzero(ends - starts >= _LONG):
        own = blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8).digest()
        out[k] = int.from_bytes(own, "little")
    return out


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int = 5):
    """(hashes, text offsets) of the k-word shingles of each text, repeats kept;
    a text of fewer words gives its whole sequence as one, no words give none."""
    starts, ends, at = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    counts = np.diff(at)
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    to = np.concatenate([[0], np.cumsum(n)])
    salts = mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    padded = np.concatenate([words, np.zeros(k, dtype=np.uint64)])
    full = np.zeros(len(words), dtype=np.uint64)
    for j in range(k):
        full += padded[j:j + len(words)] * salts[j]
    first = np.repeat(at[:-1], n) + (np.arange(to[-1]) - np.repeat(to[:-1], n))
    out = full[first] if len(first) else np.zeros(0, dtype=np.uint64)
    for row in np.flatnonzero((counts > 0) & (counts < k)):
        c = counts[row]
        own = words[at[row]:at[row + 1]] * salts[:c]
        out[to[row]] = own.sum(dtype=np.uint64) + np.uint64(c)
    return mix(out), to


def strings(values: list) -> pa.Array:
    return pa.array(values, type=pa.string())
