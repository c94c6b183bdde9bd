"""Toxicity by a classifier chain.

Categories are predicted one after another by linear (logistic) models over
words and word beginnings; each later model also gets the probabilities of the
categories before it.  While fitting, those come out of fold: the training rows
are split by a keyed hash into ``FOLDS`` parts and each part's probability comes
from a model fitted on the others, so that later links see what they will see
on new documents.  The last link is ``toxic`` itself.

The labels hold one toxicity mark, so the categories before it are groups of
its vocabulary: words that toxic rows hold far more often than others, grouped
by the rows they share.  A row has a category if it is toxic and holds one of
its words.

A link's vocabulary are the terms with the largest log odds over document
counts; their values are those log odds, so a rare term cannot outweigh a
frequent one.  Fitted on at most ``sample`` labelled rows (a documented bound)
whose crc32(doc_id) mod 5 is not 0; every document is scored, over all its
words.  Null and empty texts hold no words and get the intercepts' probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.llm.common import buffers, doc_slices, lowered, span_hashes, word_spans
from spendstar.llm.fm_quality import held_out, sampled_labels

FOLDS = 4
CATEGORIES = 3
STEMS = (4, 5)
SAMPLE = 6_000
VOCABULARY = 1_024
THRESHOLD = 0.7

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def terms(data: np.ndarray, offsets: np.ndarray):
    """(hashed terms, their text's number): the words, without marks around
    them, and their first 4 and 5 bytes; repeats kept."""
    data = lowered(data)
    starts, ends, at = word_spans(data, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    if len(starts):
        letter = np.concatenate([[0], np.cumsum(_LETTER[data])])
        place = np.flatnonzero(_LETTER[data])
        has = letter[ends] > letter[starts]  # marks before the first and after the last letter go
        first, last = place[letter[starts[has]]], place[letter[ends[has]] - 1] + 1
        starts[has], ends[has] = first, last
    parts = [span_hashes(data, starts, ends)]
    parts += [span_hashes(data, starts, np.minimum(ends, starts + k)) * np.uint64(2 * k + 1)
              for k in STEMS]
    return np.concatenate(parts), np.tile(row, len(parts))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Sample:
    """Training rows as sorted (row, term) pairs without repeats."""

    def __init__(self, row: np.ndarray, term: np.ndarray, n: int):
        self.row, self.n = row, n
        self.names, self.term = np.unique(term, return_inverse=True)

    def vocabulary(self, y: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term numbers, log odds) of the most telling terms in the given rows."""
        inside = np.zeros(self.n, dtype=bool)
        inside[rows] = True
        use = inside[self.row]
        k = len(self.names)
        df = np.bincount(self.term[use], minlength=k)
        pos = np.bincount(self.term[use], weights=y[self.row[use]], minlength=k)
        p, n = y[rows].sum(), (1 - y[rows]).sum()
        odds = np.log((pos + 1) / (p + 2)) - np.log((df - pos + 1) / (n + 2))
        kept = np.flatnonzero((df >= 4) & (np.abs(odds) >= 2))
        kept = kept[np.argsort(-np.abs(odds[kept]) * np.sqrt(df[kept]), kind="stable")[:VOCABULARY]]
        return kept, odds[kept]


def _fit(sample: Sample, y: np.ndarray, extra: np.ndarray, rows: np.ndarray,
         rounds: int = 60, rate: float = 0.5, decay: float = 1e-3) -> dict:
    """A logistic model on ``rows``: gradient descent from the log odds' own weights."""
    mean = (y[rows].sum() + 0.5) / (len(rows) + 1)
    model = {"terms": np.zeros(0, np.uint64), "w": np.zeros(0), "u": np.zeros(extra.shape[1]),
             "b": np.log(mean / (1 - mean))}
    if len(rows) == 0 or y[rows].min() == y[rows].max():
        return model
    kept, odds = sample.vocabulary(y, rows)
    place = np.full(len(sample.names), -1)
    place[kept] = np.arange(len(kept))
    inside = np.zeros(sample.n, dtype=bool)
    inside[rows] = True
    use = inside[sample.row] & (place[sample.term] >= 0)
    row, col = sample.row[use], place[sample.term[use]]
    target, weight = y, np.zeros(sample.n)
    weight[rows] = 1 / len(rows)
    w, u, b = np.full(len(kept), 0.2), model["u"], model["b"]
    for _ in range(rounds):
        z = b + np.bincount(row, weights=(w * odds)[col], minlength=sample.n) + extra @ u
        g = (_sigmoid(z) - target) * weight
        w -= rate * (np.bincount(col, weights=g[row] * odds[col], minlength=len(kept))
                     + decay * (w - 0.2))
        u = u - rate * (extra.T @ g)
        b -= rate * g.sum()
    order = np.argsort(sample.names[kept])
    return {"terms": sample.names[kept][order], "w": (w * odds)[order], "u": u, "b": float(b)}


def _prob(model: dict, row: np.ndarray, term: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """Probabilities of the rows 0..len(extra)-1; ``term`` may repeat within a row."""
    z = np.full(len(extra), model["b"]) + extra @ model["u"]
    if len(model["terms"]) and len(term):
        at = np.minimum(np.searchsorted(model["terms"], term), len(model["terms"]) - 1)
        hit = model["terms"][at] == term
        pairs = np.unique(row[hit] * len(model["terms"]) + at[hit])
        z += np.bincount(pairs // len(model["terms"]),
                         weights=model["w"][pairs % len(model["terms"])], minlength=len(extra))
    return _sigmoid(z)


def categories(sample: Sample, y: np.ndarray) -> np.ndarray:
    """0/1 columns: is the row toxic and does it hold a word of the category.

    Each category grows around the commonest marked word still free: the free
    marked words that share at least a tenth of their rows with it; the last
    one takes all that are left.
    """
    out = np.zeros((sample.n, CATEGORIES))
    kept, odds = sample.vocabulary(y, np.arange(sample.n))
    df = np.bincount(sample.term, minlength=len(sample.names))
    free = kept[odds > 3]
    free = free[np.argsort(-df[free], kind="stable")]
    toxic = y[sample.row] > 0
    row, term = sample.row[toxic], sample.term[toxic]
    for k in range(CATEGORIES):
        if not len(free):
            break
        if k + 1 < CATEGORIES:
            with_seed = np.zeros(sample.n, dtype=bool)
            with_seed[row[term == free[0]]] = True
            shared = np.bincount(term[with_seed[row]], minlength=len(sample.names))
            member = shared[free] >= 0.1 * df[free]
        else:
            member = np.ones(len(free), dtype=bool)
        own = np.zeros(len(sample.names), dtype=bool)
        own[free[member]] = True
        out[row[own[term]], k] = 1
        free = free[~member]
    return out


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> list[dict]:
    """The chain's models in order; the last one predicts ``toxic``."""
    picked = F.broadcast(sampled_labels(labels, "toxic", limit))  # at most ``limit`` rows
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                .where(F.col("text").isNotNull()).join(picked, "doc_id")
                # one text an id, the smallest: the sample bounds rows, not only ids
                .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y")))

    def distinct(batches):
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for i, j in doc_slices(offsets):
                term, row = terms(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                order = np.argsort(row, kind="stable")
                term, cut = term[order], np.searchsorted(row[order], np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), batch.column("y").slice(i, j - i),
                     pa.array([np.unique(term[a:b]).tobytes() for a, b in zip(cut, cut[1:])],
                              pa.binary())], names=["doc_id", "y", "terms"])

    got = rows.mapInArrow(distinct, "doc_id long, y int, terms binary").toPandas()
    got = got.sort_values(["doc_id", "y", "terms"], kind="stable").reset_index(drop=True)
    own = [np.frombuffer(b, np.uint64) for b in got["terms"]]
    row = np.repeat(np.arange(len(own)), [len(x) for x in own])
    sample = Sample(row, np.concatenate(own) if own else np.zeros(0, np.uint64), len(own))
    y = got["y"].to_numpy(dtype=float)
    links = np.column_stack([categories(sample, y), y])
    fold = (got["doc_id"].to_numpy(dtype=np.int64) * 2654435761 >> 16) % FOLDS
    everything, extra, chain = np.arange(len(y)), np.zeros((len(y), 0)), []
    for k in range(links.shape[1]):
        chain.append(_fit(sample, links[:, k], extra, everything))
        if k + 1 < links.shape[1]:
            out = np.zeros(len(y))
            for f in range(FOLDS):
                model = _fit(sample, links[:, k], extra, np.flatnonzero(fold != f))
                out[fold == f] = _prob(model, sample.row, sample.names[sample.term], extra)[fold == f]
            extra = np.column_stack([extra, out])
    return chain


def score(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, p_insult_1.., score (of toxic), predicted, for every row."""
    chain = train(docs, labels, limit)
    names = [f"p_insult_{k + 1}" for k in range(CATEGORIES)] + ["score"]
    known = np.unique(np.concatenate([m["terms"] for m in chain]))

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            done = [np.zeros((0, len(chain)))]
            for i, j in doc_slices(offsets, 1 << 20):
                term, row = terms(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                if len(known):
                    at = np.minimum(np.searchsorted(known, term), len(known) - 1)
                    hit = known[at] == term
                    term, row = term[hit], row[hit]
                extra = np.zeros((j - i, 0))
                for model in chain:
                    extra = np.column_stack([extra, _prob(model, row, term, extra)])
                done.append(extra)
            done = np.concatenate(done)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(done[:, k]) for k in range(len(names))]],
                names=["doc_id", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{n} double" for n in names))
    return rows.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"),
                       *names, (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
