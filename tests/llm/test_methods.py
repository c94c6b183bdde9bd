"""The operators' inner methods against plain forms of them."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

from spendstar.llm import fm_quality, mix_sources, queries, suffix_dedup, syncmers

SF = "/root/testdata/sf0.001"


def test_margins_equal_the_plain_pair_sum():
    rng = np.random.default_rng(1)
    model = {"w0": np.array([0.3]), "w": rng.normal(0, 1, fm_quality.FEATURES),
             "v": rng.normal(0, 0.3, (fm_quality.FEATURES, fm_quality.RANK))}
    sizes = [1, 5, 40, 2]
    to = np.concatenate([[0], np.cumsum(sizes)])
    index = rng.integers(0, fm_quality.FEATURES, to[-1])
    value = rng.normal(0, 1, to[-1])
    got, _ = fm_quality._margin(model, index, value, to)
    for row, (a, b) in enumerate(zip(to, to[1:])):
        want = model["w0"][0] + sum(model["w"][i] * x for i, x in zip(index[a:b], value[a:b]))
        for p in range(a, b):
            for q in range(p):
                if q >= a:
                    want += (model["v"][index[p]] @ model["v"][index[q]]) * value[p] * value[q]
        assert got[row] == pytest.approx(want)


def test_quotas_equal_a_plain_highest_quotient_loop():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 12))
        most = rng.integers(0, 40, n).tolist()
        votes = [float(rng.uniform(0, m)) if m else 0.0 for m in most]
        won = [0] * n
        for _ in range(min(round(sum(votes)), sum(most))):
            best = max((i for i in range(n) if won[i] < most[i]), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
            won[best] += 1
        assert mix_sources.sainte_lague(votes, most) == won


def test_words_taken_equal_counting_words_of_blocks():
    rng = np.random.default_rng(3)
    for _ in range(300):
        size = rng.integers(0, 30, int(rng.integers(1, 25)))
        length = int(size.sum())
        blocks = max(1, round(length / 16)) if length else 0
        quota = int(rng.integers(0, 3 * blocks + 1))
        got = np.zeros(len(size), dtype=np.int64)
        if blocks:
            every, extra = divmod(quota, blocks)
            again = mix_sources.feistel(np.arange(blocks), blocks, 7) < extra
            block_of = np.searchsorted([i * length // blocks for i in range(blocks)], np.arange(length), side="right") - 1
            doc_of = np.repeat(np.arange(len(size)), size)
            got = every * size + np.bincount(doc_of, weights=again[block_of], minlength=len(size)).astype(np.int64)
        # in one piece, and in two pieces of the stream
        assert mix_sources._taken(size, 0, length, blocks, quota, 7).tolist() == got.tolist()
        cut = int(rng.integers(0, len(size) + 1))
        parts = [mix_sources._taken(p, at, length, blocks, quota, 7).tolist()
                 for p, at in ((size[:cut], 0), (size[cut:], int(size[:cut].sum()))) if len(p)]
        assert sum(parts, []) == got.tolist()


@pytest.mark.parametrize("shard", [60, 200, 1 << 22])
def test_bucket_spans_equal_brute_force_in_any_shards(monkeypatch, shard):
    """Classes that lie in several shards are merged by binary search."""
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    rng = np.random.default_rng(shard)
    base = bytes(rng.integers(97, 100, 400).astype(np.uint8))
    for _ in range(25):
        snippets = []
        for _ in range(int(rng.integers(2, 20))):
            a, n = int(rng.integers(0, 300)), int(rng.integers(50, 99))
            snippets.append((base[a:a + n], int(rng.integers(0, 9)), len(snippets), int(rng.integers(0, 50))))
        least: dict[bytes, int] = {}
        for text, doc, _, _ in snippets:
            for i in range(len(text) - 49):
                least[text[i:i + 50]] = min(doc, least.get(text[i:i + 50], doc))
        want = set()
        for text, doc, key, start in snippets:
            hit = [least[text[i:i + 50]] < doc for i in range(len(text) - 49)] + [False]
            first = None
            for i, h in enumerate(hit):
                if h and first is None:
                    first = i
                if not h and first is not None:
                    want.add((key, start + first, start + i - 1 + 50))
                    first = None
        frame = pd.DataFrame({
            "text": [b"".join(s[0] for s in snippets)], "size": [bytes(len(s[0]) for s in snippets)],
            "docs": [np.array([s[1] for s in snippets]).tobytes()],
            "key": [np.array([s[2] for s in snippets]).tobytes()],
            "start": [np.array([s[3] for s in snippets]).tobytes()]})
        got = set()
        for r in suffix_dedup._spans(frame, 4).itertuples():
            got |= set(zip(*(np.frombuffer(b, np.int64).tolist() for b in (r.keys, r.start, r.stop))))
        assert got == want


def test_repeats_of_odd_rows(spark):
    passage = "a passage that is longer than fifty bytes stands in many documents"
    rows = [(1, passage, "k", 1, "t"), (2, f"x {passage} y", None, None, None), (2, f"x {passage} y", "k", 2, "t"),
            (3, None, "k", 0, ""), (4, "", None, 1, "t"), (None, passage, "k", 1, "t"), (5, "é" * 40_000, "k", 1, "t"),
            (6, "é" * 30, "k", 1, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, k string, id long, bucket string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(df).collect())
    n = len(passage)
    assert got == [(0, n, n, 1), (1, n, 0, 0), (2, n + 4, n, 1), (2, n + 4, n, 1), (3, 0, 0, 0), (4, 0, 0, 0),
                   (5, 80_000, 0, 0), (6, 60, 60, 1)]
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


# --- closed syncmers by plain loops ----------------------------------------------

def _signed(h):
    return h - (1 << 64) if h >= 1 << 63 else h


def _hash(*values):
    seed = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else (v & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64(raw, seed=seed & (1 << 64) - 1).intdigest()
    return _signed(seed)


def _sketch(text):
    import re
    words, k, out = [], syncmers.K, []
    for w in re.findall(r"[^\x20\x09-\x0D]+", text):
        words += [_hash(w)] if len(w) <= syncmers.STEP else [_hash(c) for c in w]
    if len(words) >= k:
        pairs = [_hash(a, b) for a, b in zip(words, words[1:])]
        for i in range(len(words) - k + 1):
            own = pairs[i:i + k - 1]
            if min(own[0], own[-1]) <= min(own[1:-1]):  # the least pair lies at an edge
                out.append(_hash(*own[0::2], words[i + k - 1]))
    if not out and words:
        out = [_hash(*words)]
    kept = set(sorted(set(out))[:syncmers.SIZE])
    return [h for h in dict.fromkeys(out) if h in kept]


def _likeness(a, b):
    low = sorted(set(a) | set(b))[:syncmers.SIZE]
    places = [b.index(h) for h in a if h in b and h in low]
    longest = []  # of the ascending sets that end at each place
    for i, p in enumerate(places):
        longest.append(1 + max((longest[j] for j in range(i) if places[j] < p), default=0))
    return max(longest, default=0) / len(low) if low else 1.0


def test_fingerprints_and_likenesses_equal_plain_loops(spark):
    texts = dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF}/documents.parquet'").fetchall())
    ids = sorted(texts)
    following = dict(zip(ids, ids[1:] + ids[:1]))
    for r in queries.op4_syncmers(spark, SF).collect():
        text, after = texts[r.doc_id], texts[following[r.doc_id]]
        q = len(text) // 4
        own, edited, other = _sketch(text), _sketch(text[:len(text) - q] + after[:q]), _sketch(after)
        written = ["".join(f"{h & (1 << 64) - 1:016X}" for h in s) for s in (own, edited)]
        assert [r.fingerprint, r.edited_fingerprint] == written, r.doc_id
        assert r.near_edited == pytest.approx(_likeness(own, edited))
        assert r.near_next == pytest.approx(_likeness(own, other))


def test_likeness_is_matched_by_position(spark):
    rng = np.random.default_rng(6)
    words = [f"w{int(i)}" for i in rng.integers(0, 5000, 160)]
    parts = [words[i:i + 40] for i in range(0, 160, 40)]
    han = "".join(chr(0x4E00 + int(i)) for i in rng.integers(0, 3000, 600))
    cases = {"same": (words, words), "moved": (words, sum(parts[::-1], [])),
             "edited": (words, words[:80] + ["new"] + words[81:])}
    rows = [(name, " ".join(a), " ".join(b)) for name, (a, b) in cases.items()]
    rows += [("inserted", han, han[:20] + "X" + han[20:]), ("empty", "", ""), ("none", "", han)]
    df = spark.createDataFrame(rows, "name string, a string, b string")
    a, b = syncmers.sketch(df.a), syncmers.sketch(df.b)
    got = {r.name: r.near for r in df.select("name", syncmers.likeness(a, b).alias("near")).collect()}
    for name, x, y in rows:
        assert got[name] == pytest.approx(_likeness(_sketch(x), _sketch(y))), name
    assert got["same"] == got["empty"] == 1.0 and got["none"] == 0.0
    assert 0.2 < got["moved"] < 0.6 and got["edited"] > 0.85 and got["inserted"] > 0.9
