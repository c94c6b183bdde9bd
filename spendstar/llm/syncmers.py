"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text's tokens are its blank-separated words of at most ``STEP`` characters and
the single characters of longer words, so that text without blanks has tokens
that an edit does not move.  A k-mer of ``K`` tokens is an anchor if the smallest
hash of its inner 2-token substrings is at its first or last place: that depends
on the k-mer alone.  The fingerprint are the ``SIZE`` smallest distinct anchor
hashes in the order of their first places.  Two fingerprints are matched by
position: likeness is the largest number of common anchors, among the ``SIZE``
smallest of either, that stand in one order in both, as a share of those
smallest; so moved parts count as far as they keep their order.  A text with
tokens but no anchor has the hash of all its tokens as its one anchor; a text
without tokens has none.

Null text is empty.  Two empty fingerprints are alike (1.0), one is not (0.0).
The next document is the next in (doc_id, digest) order, null ids first,
after the last the first; rows equal in both count as one document and give
equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendstar.llm.common import numbered, shared_table

K, STEP, SIZE = 5, 12, 64
_BODY = r"[^\x20\x09-\x0D]"
#: A word of at most ``STEP`` characters, or one character of a longer one.
TOKEN = r"(?<!%s)%s{1,%d}+(?!%s)|%s" % (_BODY, _BODY, STEP, _BODY, _BODY)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def anchors(text: Column) -> Column:
    """Hashes of a text's anchors, in its order."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))

    def of(h: Column) -> Column:
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<long>"))
        pairs = F.transform(F.sequence(F.lit(0), F.size(h) - 2), lambda i: F.xxhash64(h[i], h[i + 1]))

        def chosen(p: Column) -> Column:
            return F.filter(F.transform(
                F.sequence(F.lit(0), F.size(h) - K),
                lambda i: F.when(F.least(p[i], p[i + K - 2]) <= F.least(*[p[i + j] for j in range(1, K - 2)]),
                                 F.xxhash64(*[p[i + j] for j in range(0, K - 1, 2)], h[i + K - 1]))),
                lambda a: a.isNotNull())

        return F.when(F.size(h) >= K, let(let(pairs, chosen), lambda a: F.when(F.size(a) > 0, a)
                                          .otherwise(whole))).otherwise(whole)

    return let(hashes, of)


def sketch(text: Column) -> Column:
    """The ``SIZE`` smallest anchors, in the order of their first places."""
    return let(F.array_distinct(anchors(text)), lambda a: let(
        F.sort_array(a), lambda s: F.filter(a, lambda h: h <= F.element_at(
            s, F.greatest(F.lit(1), F.least(F.lit(SIZE), F.size(s)))))))


def _in_order(places: Column) -> Column:
    """The size of the largest set of ``places`` that ascend."""
    def longer(a: Column, p: Column) -> Column:
        before = F.array_max(F.transform(F.filter(a, lambda e: e["p"] < p), lambda e: e["n"]))
        return F.concat(a, F.array(F.struct(p.alias("p"), (F.coalesce(before, F.lit(0)) + 1).alias("n"))))

    empty = F.array().cast("array<struct<p:bigint,n:int>>")
    longest = F.array_max(F.transform(F.aggregate(places, empty, longer), lambda e: e["n"]))
    return F.when(places == F.sort_array(places), F.size(places)).otherwise(longest)


def likeness(a: Column, b: Column) -> Column:
    """Anchors of both among the ``SIZE`` smallest of either that stand in one
    order in both, as a share of those smallest."""
    def matched(low: Column) -> Column:
        shared = F.filter(a, lambda h: F.array_contains(b, h) & F.array_contains(low, h))
        places = F.transform(shared, lambda h: F.array_position(b, h))
        return F.when(F.size(low) == 0, F.lit(1.0)).otherwise(
            let(places, _in_order).cast("double") / F.size(low))

    return let(F.slice(F.sort_array(F.array_union(a, b)), 1, SIZE), matched)


def as_string(sketched: Column) -> Column:
    return F.array_join(F.transform(sketched, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, text and edited sketches, edited_sha256, likenesses."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    whole = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "text")
    rows = rows.withColumn("k", F.unhex(F.md5(whole)))  # 128 bits: texts are joined by it
    size = F.length("text")
    order = numbered(rows.select("doc_id", "k", size.cast("long").alias("n_chars")).distinct(),
                     ["doc_id", "k"], "syncmer-order")
    order = shared_table(order, "syncmer-next")
    n = order.count()
    after = order.select(F.pmod(F.col("row_no") + n - 1, F.lit(max(n, 1))).alias("row_no"),
                         F.col("k").alias("next_k"))
    follows = shared_table(order.join(after, "row_no").select("doc_id", "k", "next_k", "n_chars"), "syncmer-pairs")
    rows = rows.select("k", "text")  # both joins below read one exchange of the texts
    # what each document takes of the next one: at most a quarter of its own length
    tails = (rows.join(follows.select(F.col("k").alias("own"), F.col("next_k").alias("k"),
                                      F.expr("n_chars div 4").cast("int").alias("q")), "k")
                 .select("own", F.substring("text", F.lit(1), F.col("q")).alias("tail"))
                 .dropDuplicates(["own"]).withColumnRenamed("own", "k"))
    texts = rows.join(tails, "k").select(
        "k", "text",
        F.concat(F.substring("text", F.lit(1), size - F.floor(size / 4).cast("int")), "tail").alias("edited"))
    prints = shared_table(texts.select(
        "k", F.length("text").cast("long").alias("n_chars"), sketch(F.col("text")).alias("sketch"),
        sketch(F.col("edited")).alias("edited_sketch"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256")), "syncmer-prints")
    nexts = prints.select(F.col("k").alias("next_k"), F.col("sketch").alias("next_sketch")) \
                  .dropDuplicates(["next_k"])
    out = prints.join(follows.select("doc_id", "k", "next_k"), "k").join(nexts, "next_k")
    return out.select("doc_id", "n_chars", "sketch", "edited_sketch", "edited_sha256",
                      likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                      likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
