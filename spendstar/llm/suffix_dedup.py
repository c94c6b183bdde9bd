"""Removal of repeated passages by suffix arrays.

Every byte covered by a 50-byte string that also starts in a document with a
smaller doc_id goes.  Exact copies are resolved by a content key first; of each
content the smallest doc_id goes on.  Then:

1. Each 50-byte string picks an anchor, the 16-byte string in it with the
   smallest hash; equal strings pick equal anchors.  Anchors are counted by hash
   bucket, packed; those of two or more contents are shared.
2. Around each shared anchor the strings that picked it are cut out as one
   snippet and sent to the anchor's bucket, so equal strings meet there.
3. A bucket's snippets form shards of at most ``SHARD`` bytes.  Each shard gets
   a suffix array (Larsson-Sadakane: groups still unsorted are refined by the
   rank of the suffix h further on, h doubling) and common prefixes in text
   order (Kasai's rule); suffixes that share 50 bytes are one class with a
   smallest document.  Classes of several shards are merged by binary search.
4. Strings whose class has a smaller document give spans, which are joined to
   the documents by content and merged.

Null text is empty; texts under 50 bytes lose nothing.  A null doc_id counts as
larger than any other.  Rows that repeat a doc_id are not smaller than each
other; rows with equal text and id get equal results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.llm.common import buffers, doc_slices, mix, shared_table

LENGTH, GRAM = 50, 16
REACH = LENGTH - GRAM + 1
SHARD = 4 << 20
BUCKET_BYTES = 8 << 20
#: Windows looked up at once.
WINDOWS = 1 << 20
LAST = 2**63 - 1
_GEAR = np.random.default_rng(424242).integers(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(hash, first, last, row): for each run of windows with one anchor its hash,
    its first and last window start in ``data``, and the text's number."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none.astype(np.uint64), none, none, none
    h, step, power = _GEAR[data], 1, np.uint32(0x9E3779B1)
    while step < GRAM:
        h = h[:-step] * power + h[step:]
        power, step = np.uint32(int(power) * int(power) & 0xFFFFFFFF), 2 * step
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    low = (h.astype(np.uint64) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= REACH:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if REACH > width:
        low = np.minimum(low[:width - REACH], low[REACH - width:])
    edge = np.zeros(len(data) + 1, dtype=np.int32)
    long_ = np.flatnonzero(np.diff(offsets) >= LENGTH)
    np.add.at(edge, offsets[long_], 1)
    np.add.at(edge, offsets[long_ + 1] - LENGTH + 1, -1)
    start = np.flatnonzero(np.cumsum(edge[:len(low)]) > 0)
    if not len(start):
        return none.astype(np.uint64), none, none, none
    place = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)])
    heads = np.flatnonzero(new)
    first, last = start[heads], start[np.append(heads[1:], len(start)) - 1]
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    place = place[heads]
    code = mix(mix(words[place] + np.uint64(0x9E3779B97F4A7C15)) ^ words[place + 8])
    return code, first, last, np.searchsorted(offsets, first, side="right") - 1


def _codes(code: np.ndarray, buckets: int):
    """(bucket, code within buckets): the bucket from high bits, 32 low bits kept."""
    bucket = (code >> np.uint64(33)) % np.uint64(buckets)
    return bucket, (bucket << np.uint64(32)) | (code & np.uint64(0xFFFFFFFF))


def _counted(buckets: int):
    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            tags = batch.column("k").to_numpy(zero_copy_only=False).astype(np.uint64)
            for i, j in doc_slices(offsets):
                code, _, _, row = anchors(np.ascontiguousarray(data[offsets[i]:offsets[j]]),
                                          offsets[i:j + 1] - offsets[i])
                _, own = _codes(code, buckets)
                tag = tags[i + row] & np.uint64(0xFFFFFFFF)
                order = np.lexsort((tag, own))
                own, tag = own[order], tag[order]
                new = np.ones(len(own), dtype=bool)
                new[1:] = (own[1:] != own[:-1]) | (tag[1:] != tag[:-1])
                own, tag = own[new], tag[new]
                bucket = (own >> np.uint64(32)).astype(np.int64)
                heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) \
                    if len(own) else np.zeros(0, np.int64)
                cuts = np.append(heads, len(own))
                low, tag = own.astype(np.uint32), tag.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[heads]),
                     pa.array([low[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                     pa.array([tag[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                    names=["bucket", "low", "tag"])
    return run


def _shared(buckets: int):
    """(part, tag, code): the bucket's anchors of two or more contents, packed by
    part of the content tags."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        low = np.frombuffer(b"".join(pdf["low"]), np.uint32).astype(np.uint64)
        tag = np.frombuffer(b"".join(pdf["tag"]), np.uint32).astype(np.uint64)
        pair = np.unique((low << np.uint64(32)) | tag)
        low = pair >> np.uint64(32)
        same = np.concatenate([[False], low[1:] == low[:-1]])
        pair = pair[same | np.append(same[1:], False)]
        tag = pair & np.uint64(0xFFFFFFFF)
        part = (tag % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, tag = part[order], tag[order].astype(np.uint32)
        code = (np.uint64(pdf["bucket"].iloc[0]) << np.uint64(32)) | (pair[order] >> np.uint64(32))
        cuts = np.append(_heads(part), len(part))
        return pd.DataFrame({"part": part[cuts[:-1]],
                             "tag": [tag[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                             "code": [code[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]})
    return run


def _heads(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(values):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


def _by_tag(pdf: pd.DataFrame) -> pd.DataFrame:
    """(tag, codes): all shared anchors of each content tag of a part."""
    tag = np.frombuffer(b"".join(pdf["tag"]), np.uint32).astype(np.int64)
    code = np.frombuffer(b"".join(pdf["code"]), np.uint64)
    order = np.argsort(tag, kind="stable")
    tag, code = tag[order], code[order]
    cuts = np.append(_heads(tag), len(tag))
    return pd.DataFrame({"tag": tag[cuts[:-1]],
                         "codes": [code[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]})


def _snippets(buckets: int):
    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            keys = batch.column("k").to_numpy(zero_copy_only=False)
            codes = batch.column("codes")
            for i, j in doc_slices(offsets):
                part = np.ascontiguousarray(data[offsets[i]:offsets[j]])
                at = offsets[i:j + 1] - offsets[i]
                code, first, last, row = anchors(part, at)
                bucket, own = _codes(code, buckets)
                wanted = np.frombuffer(b"".join(codes.slice(i, j - i).to_pylist()),
                                       np.uint64)
                use = np.flatnonzero(np.isin(own, wanted))
                use = use[np.argsort(bucket[use], kind="stable")]
                if not len(use):
                    continue
                bucket, first, last, row = bucket[use].astype(np.int64), first[use], last[use], row[use]
                size = last - first + LENGTH
                to = np.concatenate([[0], np.cumsum(size)])
                text = part[np.repeat(first - to[:-1], size) + np.arange(to[-1])]
                heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                cuts = np.append(heads, len(use))
                docs, key, start = ids[i + row], keys[i + row], (first - at[row]).astype(np.int64)
                size = size.astype(np.uint8)
                spans = list(zip(cuts, cuts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[heads]),
                     pa.array([text[to[a]:to[b]].tobytes() for a, b in spans], pa.binary()),
                     pa.array([size[a:b].tobytes() for a, b in spans], pa.binary()),
                     pa.array([docs[a:b].tobytes() for a, b in spans], pa.binary()),
                     pa.array([key[a:b].tobytes() for a, b in spans], pa.binary()),
                     pa.array([start[a:b].tobytes() for a, b in spans], pa.binary())],
                    names=["bucket", "text", "size", "docs", "key", "start"])
    return run


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Larsson-Sadakane: sorted by eight bytes, then only groups that are still
    unsorted are refined by the rank h further on."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.ndarray((n,), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    sa = np.argsort(key, kind="stable")
    heads = np.concatenate([[True], key[sa[1:]] != key[sa[:-1]]])
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = 0
    rank[sa] = np.maximum.accumulate(np.where(heads, np.arange(n), 0)) + 1
    h = 8
    open_ = np.flatnonzero(~(heads & np.append(heads[1:], True)))
    while len(open_):
        rows = sa[open_]
        key = (rank[rows] << 32) | rank[np.minimum(rows + h, n)]
        order = np.argsort(key, kind="stable")
        rows, key = rows[order], key[order]
        sa[open_] = rows
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[rows] = open_[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))] + 1
        open_ = open_[~(new & np.append(new[1:], True))]
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each position the prefix shared with the suffix before it in ``sa``, at
    most ``left`` (the bytes to its snippet's end).  By Kasai's rule a position
    whose preceding byte equals that of its predecessor has one byte less than
    the position before it; only the others are compared, eight bytes at once."""
    n = len(text)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    prior = np.maximum(before, 0)
    own = np.ones(n, dtype=bool)
    own[1:] = (text[:-1] != text[prior[1:] - 1]) | (prior[1:] == 0) | (before[1:] < 0) | (left[1:] > left[:-1])
    at = np.flatnonzero(own)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.ndarray((n + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = np.zeros(n, dtype=np.int64)
    live = at[before[at] >= 0]
    while len(live):
        x, y = words[live + size[live]], words[prior[live] + size[live]]
        diff = x ^ y
        low = diff & (~diff + np.uint64(1))
        same = np.where(diff == 0, 8, (np.log2(np.maximum(low, 1).astype(np.float64)) / 8).astype(np.int64))
        size[live] += same
        live = live[(diff == 0) & (size[live] < left[live])
                    & (prior[live] + size[live] < n) & (live + size[live] < n)]
    source = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    return np.minimum(np.maximum(size[source] - (np.arange(n) - source), 0), left)


def _classes(text: np.ndarray, left: np.ndarray, smallest: np.ndarray):
    """(window starts in suffix order, class of each, smallest document by class)."""
    sa = suffix_array(text)
    shared = common_prefixes(text, sa, left)
    sa = sa[left[sa] >= LENGTH]
    new = shared[sa] < LENGTH
    new[:1] = True
    heads = np.flatnonzero(new)
    low = np.minimum.reduceat(smallest[sa], heads) if len(sa) else np.zeros(0, np.int64)
    return sa, np.cumsum(new) - 1, low


def _bucket_spans(key_parts: int):
    return lambda pdf: _spans(pdf, key_parts)


def _spans(pdf: pd.DataFrame, key_parts: int) -> pd.DataFrame:
    """(part, keys, start, stop): the strings of the bucket that a smaller document
    holds, packed by part of the content keys; ids are only compared."""
    text = b"".join(pdf["text"])
    size = np.frombuffer(b"".join(pdf["size"]), np.uint8).astype(np.int64)
    docs = np.frombuffer(b"".join(pdf["docs"]), np.int64)
    key = np.frombuffer(b"".join(pdf["key"]), np.int64)
    start = np.frombuffer(b"".join(pdf["start"]), np.int64)
    cuts = np.concatenate([[0], np.cumsum(size)])
    known: dict[bytes, int] = {}
    which = np.array([known.setdefault(text[a:b], len(known)) for a, b in zip(cuts, cuts[1:])])
    parts = list(known)
    smallest = np.full(len(parts), LAST)
    np.minimum.at(smallest, which, docs)
    # shards of whole snippets, each ended by a byte that UTF-8 never holds
    length = np.array([len(p) + 1 for p in parts])
    at = np.concatenate([[0], np.cumsum(length)])
    buffer = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)
    left = np.repeat(at[1:] - 1, length) - np.arange(at[-1])
    low = np.repeat(smallest, length)
    least = np.full(at[-1], LAST)  # by window: the smallest document of its class
    shards, i = [], 0
    while i < len(parts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + SHARD, side="right")) - 1)
        shards.append((at[i], at[j]))
        i = j
    sorted_ = [(a, *_classes(buffer[a:b], left[a:b], low[a:b])) for a, b in shards]
    if len(sorted_) > 1:
        _merge_shards(buffer, sorted_)
    for a, sa, group, best in sorted_:
        least[a + sa] = best[group]
    count = size - LENGTH + 1
    runs = [_runs(least, at[which[i:j]], count[i:j], docs[i:j], key[i:j], start[i:j])
            for i, j in doc_slices(np.concatenate([[0], np.cumsum(count)]), WINDOWS)]
    keys, begin, end = (np.concatenate(c) for c in zip(*runs))
    part = keys % key_parts
    order = np.argsort(part, kind="stable")
    part, keys, begin, end = part[order], keys[order], begin[order], end[order]
    cuts = np.append(_heads(part), len(part))
    return pd.DataFrame({"part": part[cuts[:-1]]} | {
        name: [c[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        for name, c in (("keys", keys), ("start", begin), ("stop", end))})


def _runs(least: np.ndarray, place: np.ndarray, count: np.ndarray, docs: np.ndarray,
          key: np.ndarray, start: np.ndarray):
    """(keys, starts, stops) of the runs of windows whose class has a smaller
    document, for occurrences that begin at ``place`` in the bucket's text."""
    row = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    hit = least[place[row] + offset] < docs[row]
    row, offset = row[hit], offset[hit]
    if not len(row):
        return row, row, row
    heads = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)]))
    tails = np.append(heads[1:], len(row)) - 1
    return (key[row[heads]], start[row[heads]] + offset[heads],
            start[row[tails]] + offset[tails] + LENGTH)


def _by_key(pdf: pd.DataFrame) -> pd.DataFrame:
    """(k, start, stop): each content's maximal removed runs, packed."""
    keys, start, stop = (np.frombuffer(b"".join(pdf[c]), np.int64) for c in ("keys", "start", "stop"))
    order = np.lexsort((start, keys))
    keys, start, stop = keys[order], start[order], stop[order]
    new = np.zeros(len(keys), dtype=np.int64)
    new[_heads(keys)] = 1
    lift = np.cumsum(new) * (stop.max(initial=0) + 1)  # contents never touch
    reach = np.maximum.accumulate(stop + lift)
    heads = np.flatnonzero(np.concatenate([[True], start[1:] + lift[1:] > reach[:-1]])) \
        if len(keys) else np.zeros(0, np.int64)
    tails = np.append(heads[1:], len(keys))[:len(heads)] - 1
    begin, end, keys = start[heads], reach[tails] - lift[tails], keys[heads]
    cuts = np.append(_heads(keys), len(keys))
    return pd.DataFrame({"k": keys[cuts[:-1]],
                         "start": [begin[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                         "stop": [end[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]})


def _merge_shards(buffer: np.ndarray, shards: list) -> None:
    """Lowers each class's smallest document to that of equal strings in other
    shards: their sorted class strings are searched in each other."""
    view = np.ndarray((len(buffer) - LENGTH + 1,), dtype=f"S{LENGTH}", buffer=buffer, strides=(1,))
    keys = [view[a + sa[np.searchsorted(group, np.arange(len(best)))]] for a, sa, group, best in shards]
    for x in range(len(shards)):
        for y in range(x + 1, len(shards)):
            if not len(keys[x]) or not len(keys[y]):
                continue
            at = np.minimum(np.searchsorted(keys[y], keys[x]), len(keys[y]) - 1)
            mine = np.flatnonzero(keys[y][at] == keys[x])
            other = at[mine]
            low = np.minimum(shards[x][3][mine], shards[y][3][other])
            shards[x][3][mine], shards[y][3][other] = low, low


def _cut(batches):
    empty = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        copy = batch.column("copy").to_pylist()
        start, stop = batch.column("start"), batch.column("stop")
        removed, runs, digest, kept = [], [], [], []
        for i in range(batch.num_rows):
            own = data[offsets[i]:offsets[i + 1]]
            if copy[i] and len(own) >= LENGTH:
                removed.append(len(own))
                runs.append(1)
                digest.append(empty)
                kept.append(b"")
            elif not start[i].is_valid:
                removed.append(0)
                runs.append(0)
                kept.append(own.tobytes())
                digest.append(hashlib.sha256(kept[-1]).hexdigest())
            else:
                lo = np.frombuffer(start[i].as_py(), np.int64)
                hi = np.frombuffer(stop[i].as_py(), np.int64)
                edge = np.zeros(len(own) + 1, dtype=np.int8)
                edge[lo], edge[hi] = 1, -1
                gone = np.cumsum(edge[:-1], dtype=np.int8) > 0
                removed.append(int((hi - lo).sum()))
                runs.append(len(lo))
                kept.append(own[~gone].tobytes())
                digest.append(hashlib.sha256(kept[-1]).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
             pa.array(runs, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining
    bytes, which need not be whole characters) for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("k", F.xxhash64("text", F.octet_length("text")))
    known = shared_table(rows.select("id", "k", F.octet_length("text").alias("n")), "suffix-known")
    first = shared_table(known.groupBy("k").agg(F.min("id").alias("first")), "suffix-first")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(8, -(-total // BUCKET_BYTES))
    tagged = rows.select("k", "text").mapInArrow(_counted(buckets), "bucket long, low binary, tag binary")
    shared = tagged.groupBy("bucket").applyInPandas(_shared(buckets), "part long, tag binary, code binary")
    by_tag = shared_table(shared.groupBy("part").applyInPandas(_by_tag, "tag long, codes binary"),
                          "suffix-shared")
    wanted = (first.withColumn("tag", F.col("k").bitwiseAND(F.lit(0xFFFFFFFF))).join(by_tag, "tag")
                   .select(F.col("first").alias("id"), "k", "codes"))
    cut = (rows.select("id", "k", "text").join(wanted, ["id", "k"]).select("id", "k", "text", "codes")
               .mapInArrow(_snippets(buckets), "bucket long, text binary, size binary, docs binary, key binary, "
                                               "start binary"))
    parts = max(8, buckets // 8)
    packed = cut.groupBy("bucket").applyInPandas(
        _bucket_spans(parts), "part long, keys binary, start binary, stop binary")
    by_key = shared_table(packed.groupBy("part").applyInPandas(_by_key, "k long, start binary, stop binary"),
                          "suffix-spans")
    copies = (known.join(first, "k").where(F.col("id") > F.col("first"))
                   .select("id", "k", F.lit(True).alias("copy")).distinct())
    facts = (first.select(F.col("first").alias("id"), "k").join(by_key, "k")
                  .select("id", "k", "start", "stop", F.lit(False).alias("copy"))
                  .unionByName(copies, allowMissingColumns=True))
    return (rows.join(facts, ["id", "k"], "left").select("doc_id", "text", "start", "stop", "copy")
                .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                  "kept_sha256 string, kept binary"))
