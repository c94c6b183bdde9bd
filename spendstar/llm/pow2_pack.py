"""Packing by power-of-two decomposition.

A document's ids (its tokens, then one end id) are split into pieces of
``window`` ids and then the binary digits of the rest, largest first.  Every
piece is a sequence of its own: no sequence crosses documents, none is padded
(each is a power of two long), and sequences of one length form a bucket that
a trainer batches together.  ``sequence_id`` numbers the sequences densely,
bucket by bucket, longest first.

Null text is empty: one piece that holds the end id.  Repeated rows are packed
each for itself; an empty table gives no pieces.
"""

from __future__ import annotations

import itertools
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendstar.llm.common import (buffers, doc_slices, lowered, shared_table, span_hashes,
                                  word_spans)

WINDOW = 2048
END_ID = 1
_KNOWN_RUNS, _AT_ONCE, _JOINED = 500_000, 2048, 256
#: Byte classes: letters (all bytes above ASCII count as such), digits, marks.
_KIND = np.full(256, 3, dtype=np.uint8)
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
#: A word with one of these is coded whole: control bytes, the apostrophe of
#: contractions and "<", which may open a special token.
_WHOLE = np.zeros(256, dtype=bool)
_WHOLE[:33] = _WHOLE[127] = _WHOLE[39] = _WHOLE[60] = True


def _runs(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, first run of each text, parts) of the runs that the tokenizer
    codes one by one: runs of one kind within a word of ASCII and Latin-1 letters,
    else the whole word.  It drops blanks and never joins across runs.  It splits a
    run into ``parts`` that it codes (each digit is one); 0 for a whole word, which
    may hold any number."""
    starts, ends, at = word_spans(data, offsets)
    kind = _KIND[data]
    lead, high = data == 0xC3, data >= 0x80
    after = np.concatenate([[False], lead[:-1]]) & (data < 0xC0) & (data != 0x97) & (data != 0xB7)
    whole = _WHOLE[data] | (high & ~lead & ~after)
    count = np.zeros(len(data) + 1, dtype=np.int32)
    np.cumsum(whole, out=count[1:])
    odd = count[ends] > count[starts]
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[starts[~odd]] += 1
    inside[ends[~odd]] -= 1  # an end may be a start, two ends are never one
    split = np.cumsum(inside[:-1], dtype=np.int8) > 0
    split[1:] &= kind[1:] != kind[:-1]
    split[starts] = True
    first = np.flatnonzero(split)
    word = np.searchsorted(starts, first, side="right") - 1
    last = np.minimum(np.append(first[1:], len(data)), ends[word]) if len(first) else first
    parts = np.where(odd[word], 0, np.where(kind[first] == 2, last - first, 1))
    return first, last, np.searchsorted(first, offsets), parts


class _Ids:
    """Token ids of texts; a bounded memo in arrays keeps those of known runs."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # the ids that end a part, where the vocabulary marks them
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(1 + max(vocabulary.values(), default=0), dtype=bool)
        if suffix:
            self.last[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self._empty()

    def _empty(self) -> None:
        self.names = np.zeros(0, np.uint64)
        self.start = self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _code(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts in turn, number of ids of each)."""
        coded = [c.ids for a in range(0, len(texts), _AT_ONCE) for c in
                 self.tokenizer.encode_batch_fast(texts[a:a + _AT_ONCE], add_special_tokens=False)]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        return np.fromiter(itertools.chain.from_iterable(coded), np.uint32, int(size.sum())), size

    def _code_joined(self, runs: list[str], parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of runs of known ``parts``, many to a text: blanks keep them
        apart, and the ids that end a part tell where each run ends."""
        flat, _ = self._code([" ".join(runs[a:a + _JOINED]) for a in range(0, len(runs), _JOINED)])
        ends, wanted = np.flatnonzero(self.last[np.minimum(flat, len(self.last) - 1)]), np.cumsum(parts)
        if len(runs) and (len(ends) != wanted[-1] or ends[-1] != len(flat) - 1):
            return self._code(runs)  # a tokenizer that marks no ends, or splits otherwise
        return flat, np.diff(ends[wanted - 1] + 1, prepend=0)

    def _learn(self, names: np.ndarray, runs: list[str], parts: np.ndarray) -> None:
        if len(self.names) + len(names) > max(_KNOWN_RUNS, len(names)):
            self._empty()
        plain, whole = np.flatnonzero(parts), np.flatnonzero(parts == 0)
        flat, size = (np.concatenate(two) for two in zip(
            self._code_joined([runs[i] for i in plain], parts[plain]), self._code([runs[i] for i in whole])))
        start = len(self.flat) + np.cumsum(size) - size
        names = np.concatenate([self.names, names[plain], names[whole]])
        order = np.argsort(names)
        self.names = names[order]
        self.start = np.concatenate([self.start, start])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.flat = np.concatenate([self.flat, flat])

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, number of ids of each)."""
        starts, ends, at, parts = _runs(data, offsets)
        names, where, which = np.unique(span_hashes(lowered(data), starts, ends),
                                        return_index=True, return_inverse=True)
        for _ in range(2):  # twice where the memo was emptied
            place = np.searchsorted(self.names, names)
            place[place == len(self.names)] = 0
            new = self.names[place] != names if len(self.names) else np.ones(len(names), dtype=bool)
            if not new.any():
                break
            raw = data.tobytes()
            self._learn(names[new], [raw[starts[i]:ends[i]].decode() for i in where[new]], parts[where[new]])
        place = np.searchsorted(self.names, names)
        size = self.size[place][which] if len(names) else np.zeros(0, np.int64)
        to = np.concatenate([[0], np.cumsum(size)])
        begin = self.start[place][which] if len(names) else size
        flat = self.flat[np.repeat(begin - to[:-1], size) + np.arange(to[-1])]
        return flat, np.diff(to[at])


_LOADED: dict[str, _Ids] = {}


def piece_lengths(total: int, window: int = WINDOW) -> list[int]:
    rest = total % window
    return [window] * (total // window) + \
        [1 << b for b in range(window.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (binary, little-endian uint32), and the
    piece's place ``_slot`` among those of its length in partition ``_part``."""
    def split(batches):
        ids = _LOADED.get(tokenizer) or _LOADED.setdefault(tokenizer, _Ids(tokenizer))
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for i, j in doc_slices(offsets, 1 << 20):
                flat, counts = ids.texts(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
                rows, start, length, total, slot = [], [], [], [], []
                for k, n in enumerate((counts + 1).tolist()):
                    at = 0
                    for size in piece_lengths(n, window):
                        rows.append(i + k)
                        start.append(at)
                        length.append(size)
                        total.append(n)
                        slot.append(seen.get(size, 0))
                        seen[size] = slot[-1] + 1
                        at += size
                cuts = np.concatenate([[0], np.cumsum(length)]) * 4
                binary = pa.Array.from_buffers(
                    pa.large_binary(), len(length),
                    [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(total, pa.int64()), binary.cast(pa.binary()),
                     pa.array(slot, pa.int64()), pa.array([part] * len(rows), pa.int32())],
                    names=["doc_id", "start", "length", "doc_tokens", "ids", "_slot", "_part"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        split, "doc_id long, start long, length long, doc_tokens long, ids binary, "
               "_slot long, _part int")


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids, sequence_id, offset."""
    cut = shared_table(pieces(docs, tokenizer, window, end_id), "pack-pieces")
    runs = cut.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    order = Window.orderBy(F.desc("length"), "_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0))).drop("_n")
    return (cut.join(F.broadcast(runs), ["length", "_part"])  # lengths x partitions rows
               .select("doc_id", "start", "length", "doc_tokens", "ids",
                       (F.col("_before") + F.col("_slot")).alias("sequence_id"),
                       F.lit(0).cast("long").alias("offset")))
