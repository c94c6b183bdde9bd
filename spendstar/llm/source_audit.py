"""Source divergence audit: how differently the sources of a language use words.

Terms are runs of letters A-Z, a-z and of all characters beyond ASCII, A-Z
lower-cased.  A language keeps the V terms that occur in at least ``MIN_DOCS``
of its documents (rows).  A group (lang, source), and the language as a whole,
gives a kept term with ``count`` occurrences there (0 or more)
p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N the sum of its counts.  Two such
numbers differ by f = floor((p - q)^2 / (p + q)).

``pairs``: for any two sources of a language, the sum of f over all kept terms.
Each group holds its kept terms as sorted (term id, count) arrays, cut into
segments of ``SEGMENT`` ids.  A task co-groups the arrays of two tiles of
``TILE`` sources (so an array travels to sources / TILE tasks, not to one for
each other source) and merges every unordered pair of sources between them
once: a galloping intersection finds the overlap, overlapping and one-sided
terms are priced there, and the terms that neither has, which all cost the
same, by their number.  The value holds for both directions.

``terms``: for each group, its ``top`` terms of highest f among those it uses
more than its language does.

Counting: each batch of texts is split as bytes and counted into (lang, source,
term) sums that are handed over as often as ``FLUSH`` of them are held; Spark
adds them up with partial aggregates.  Long texts are cut at separators.

Defined results: null text, lang and source read as ''; a group without kept
terms is compared like any other; a language that keeps no term has pair value
0 and no term rows; each row is a document, also a repeated one; other columns
are not read; an empty table gives no rows.  Arithmetic is on integers, exact
while N + 2 V < 9 * 10^15 and by Python's integers beyond.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendstar.llm.common import numbered, shared_table

MIN_DOCS = 10
TOP = 10
TILE = 4
SEGMENT = 1 << 17
FLUSH = 400_000
SCALE = 1_000_000_000
_CUT = 1 << 20
_RUN = 1024

#: ASCII but letters separates; A-Z are lower-cased; bytes beyond ASCII stay.
_SPLIT = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _terms(text: str):
    """The terms of a text, as lists, a bounded piece at a time."""
    data, at = text.encode().translate(_SPLIT), 0
    while at < len(data):
        end = data.find(b" ", at + _CUT)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _count(batches):
    """lang, source, text -> lang, source, term, n, docs (partial sums)."""
    held: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for part in _terms(text.as_py()):
                n.update(part)
                seen.update(part)
            docs.update(seen)
            size += len(n) - before
            if size >= FLUSH:
                yield from _counts(held)
                held, size = {}, 0
    yield from _counts(held)


def _counts(held: dict):
    for (lang, source), (n, docs) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.repeat(pa.scalar(source, pa.string()), len(n)),
             pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
             pa.array([docs[t] for t in n], pa.int64())], names=["lang", "source", "term", "n", "docs"])


# --- the merge of two sorted arrays -------------------------------------------

def gallop(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each of the ascending ``few`` its place in the ascending ``many``, or
    -1.  Each run of ids doubles its stride from the last place until it has
    passed the run's end, then searches the stretch it has passed."""
    out, low = np.full(len(few), -1, dtype=np.int64), 0
    for i in range(0, len(few), _RUN):
        run, high, stride = few[i:i + _RUN], low, _RUN
        while high < len(many) and many[high] <= run[-1]:
            high, stride = high + stride, stride * 2
        stretch = many[low:high]
        at = np.searchsorted(stretch, run)
        inside = at < len(stretch)
        inside[inside] = stretch[at[inside]] == run[inside]
        out[i:i + _RUN][inside] = low + at[inside]
        low += int(at[-1])
    return out


def weight(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / total), exactly, by division a thousandth at a time."""
    if total >= 9 * 10**15:
        return np.array([1 + SCALE * (int(c) + 2) // total for c in counts], dtype=np.int64)
    out, rest = np.zeros(len(counts), dtype=np.int64), counts.astype(np.int64) + 2
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def distance(p, q):
    d = p - q
    return d * d // (p + q)


def _merged(x: tuple, y: tuple) -> tuple[int, int]:
    """(summed f over the terms that x or y has, their number); x, y: (ids,
    weights, weight of an absent term)."""
    if len(x[0]) > len(y[0]):
        x, y = y, x
    at = gallop(x[0], y[0])
    both = at >= 0
    alone = np.ones(len(y[0]), dtype=bool)
    alone[at[both]] = False
    value = (distance(x[1][both], y[1][at[both]]).sum() + distance(x[1][~both], y[2]).sum()
             + distance(y[1][alone], x[2]).sum())
    return int(value), len(x[0]) + int(alone.sum())


def _groups(table: pa.Table) -> list[tuple]:
    """(source, N, ids, weights, weight of an absent term) of each row."""
    out, v = [], table.column("v").to_pylist()
    lists = table.column("terms").combine_chunks()
    for i, (source, total) in enumerate(zip(table.column("source").to_pylist(),
                                            table.column("total").to_pylist())):
        ids = counts = np.zeros(0, dtype=np.int64)
        if lists[i].is_valid:
            ids, counts = (c.to_numpy(zero_copy_only=False) for c in lists[i].values.flatten())
        whole = total + 2 * v[i]
        absent = int(weight(np.zeros(1, dtype=np.int64), whole)[0]) if whole else 0
        out.append((source, total, ids, weight(counts, whole) if whole else counts, absent))
    return out


def _merge_tiles(key, left: pa.Table, right: pa.Table) -> pa.Table:
    lang, _, a, b = (k.as_py() for k in key)
    rows, ys = [], _groups(right)
    for x in _groups(left):
        for y in ys:
            if a < b or x[0] < y[0]:
                rows.append((lang, x[0], y[0], x[1], y[1], *_merged(x[2:], y[2:])))
    cols = list(zip(*rows)) if rows else [()] * 7
    return pa.table([pa.array(list(c), pa.string() if i < 3 else pa.int64())
                     for i, c in enumerate(cols)], names=["lang", "x", "y", "nx", "ny", "priced", "held"])


# --- Spark -------------------------------------------------------------------

def _p(count: str, total: str) -> str:
    return f"(1 + cast({SCALE}BD * ({count} + 2) div ({total} + 2 * v) as bigint))"


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


class Audit:
    """The audit of ``docs`` (text, lang, source): ``pairs`` (lang, source, item,
    value) and ``terms`` (lang, source, item, value, rank)."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP):
        self.top = top
        rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                             for c in ("lang", "source", "text")])
        sums = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
        sums = sums.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        kept = (sums.groupBy("lang", "term")
                .agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"),
                     F.collect_list(F.struct("source", "n")).alias("uses"))
                .where(F.col("docs") >= min_docs).drop("docs"))
        self.vocabulary = shared_table(numbered(kept, ["lang", "term"], "audit-vocabulary", "id"),
                                       "audit-terms")
        langs = self.vocabulary.groupBy("lang").agg(
            F.count("*").alias("v"), F.sum("all").alias("lang_total"), F.min("id").alias("low"),
            F.max("id").alias("high"))
        self.uses = self.vocabulary.select("lang", "id", "term", "all", F.inline("uses"))
        totals = self.uses.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = rows.select("lang", "source").distinct() \
                     .join(langs, "lang", "left").join(totals, ["lang", "source"], "left") \
                     .na.fill(0, ["v", "lang_total", "total", "low", "high"])
        # one row a group: its place among the sources of its language
        place = Window.partitionBy("lang").orderBy("source")
        whole = Window.partitionBy("lang")
        self.groups = shared_table(groups.select(
            "*", F.floor((F.row_number().over(place) - 1) / TILE).cast("int").alias("tile"),
            F.floor((F.count("*").over(whole) - 1) / TILE).cast("int").alias("last_tile")), "audit-groups")

    def pairs(self) -> DataFrame:
        segment = F.floor(F.col("id") / SEGMENT).cast("long")
        arrays = self.uses.groupBy("lang", "source", segment.alias("segment")).agg(
            F.sort_array(F.collect_list(F.struct("id", "n"))).alias("terms"))
        first, last = (F.floor(F.col(c) / SEGMENT).cast("long") for c in ("low", "high"))
        held = shared_table(self.groups.withColumn("segment", F.explode(F.sequence(first, last)))
                            .join(arrays, ["lang", "source", "segment"], "left"), "audit-arrays")
        key, rest = ["lang", "segment", "a", "b"], ["source", "total", "v", "terms"]
        left = held.select("lang", "segment", F.col("tile").alias("a"),
                           F.explode(F.sequence("tile", "last_tile")).alias("b"), *rest)
        right = held.select("lang", "segment", F.explode(F.sequence(F.lit(0), F.col("tile"))).alias("a"),
                            F.col("tile").alias("b"), *rest).toDF(*key, *rest)
        priced = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
            _merge_tiles, "lang string, x string, y string, nx long, ny long, priced long, held long")
        sums = priced.groupBy("lang", "x", "y", "nx", "ny").agg(
            F.sum("priced").alias("priced"), F.sum("held").alias("held"))
        sums = sums.join(self.groups.select("lang", "v").distinct(), "lang").select(
            "lang", "x", "y", F.when(F.col("v") == 0, F.lit(0)).otherwise(F.expr(
                f"priced + (v - held) * {_f(_p('0L', 'nx'), _p('0L', 'ny'))}")).alias("value"))
        return sums.select("lang", "value", F.explode(F.array(
            F.struct(F.col("x").alias("source"), F.col("y").alias("item")),
            F.struct(F.col("y").alias("source"), F.col("x").alias("item")))).alias("_e")) \
            .select("lang", "_e.*", "value")

    def terms(self) -> DataFrame:
        scored = self.uses.join(self.groups.select("lang", "source", "total", "lang_total", "v"),
                                ["lang", "source"]) \
            .withColumn("p", F.expr(_p("n", "total"))).withColumn("q", F.expr(_p("all", "lang_total"))) \
            .where("p > q").select("lang", "source", F.col("term").alias("item"),
                                   F.expr(_f("p", "q")).alias("value"))
        return ranked(scored).where(F.col("rank") <= self.top)


def ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    found = Audit(docs, min_docs, top)
    cols = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank"]
    return ranked(found.pairs()).withColumn("part", F.lit("pair")).select(*cols).unionByName(
        found.terms().withColumn("part", F.lit("term")).select(*cols))
