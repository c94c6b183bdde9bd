"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Base spans are emails, IP addresses, card and phone numbers by fixed patterns.
Removing them is not enough where other words give them away, so every term
(a run of letters, marks and digits outside base spans) of the texts that
hold a protected entity is judged by corpus co-occurrence: with n different
texts, n_e with entity e, n_t with term t, and n_te with both, t reveals the share

    (log2(n / n_e) + log2(n_te / n_t)) / log2(n / n_e)

of e's information.  Terms that share at least ``SUPPORT`` texts with e are
generalised from ``GENERALISE`` on and removed from ``REMOVE`` on, at every place
in the texts that hold e.  n_t counts all texts.  All counts are of different
texts (by a 128-bit digest): copies and repeated rows are no further evidence.
So an entity that one text alone holds has no term judged: with ``SUPPORT`` 1
every word of that text would reveal it.

Null text is empty and has no spans.  Rows of equal text get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendstar.llm.common import shared_table
from spendstar.llm.syncmers import let

#: The contract's patterns.  Each is written so that no start
#: inside a run is tried after the run's own start has failed (same matches,
#: linear time): possessive runs, and no start after a character of the run
#: unless a match has just ended there (\G).
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts that cannot hold the kind are passed over.
MAYBE = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]+\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
TERM = r"[\p{L}\p{M}\p{N}]++"
SUPPORT = 2
#: Stands for each character of a base span while terms are sought.
HIDDEN = "\uFFFF"
GENERALISE, REMOVE = 0.75, 0.9
_SPAN = "array<struct<start:int,stop:int,found:string>>"


def located(text: Column, pattern: str) -> Column:
    """[start, stop, found] of a pattern's matches, in code points."""
    def place(z: Column) -> Column:
        between, found = z["between"], z["found"]
        start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

        def step(a: Column, i: Column) -> Column:
            begin = a["at"] + F.length(between[i])
            end = begin + F.length(found[i])
            span = F.struct(begin.alias("start"), end.alias("stop"), found[i].alias("found"))
            return F.struct(end.alias("at"), F.concat(a["spans"], F.array(span)).alias("spans"))

        walked = F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, step)["spans"]
        return F.when(F.size(found) > 0, walked).otherwise(F.array().cast(_SPAN))

    return let(F.struct(F.split(text, pattern, -1).alias("between"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")), place)


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _holds(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":  # no part above 255, leading zeros aside
        return ~found.rlike(r"(?:^|\.)0*(?:[1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])(?:\.|$)")
    if kind == "card":
        return let(digits, lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    spans = F.filter(located(text, KINDS[kind]), lambda s: _holds(kind, s["found"]))
    return F.when(MAYBE[kind](text), spans).otherwise(F.array().cast(_SPAN))


def joined(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["stop"]))


def _with(spans: str, **fields: Column | None) -> Column:
    """[start, stop, fields] of a column of spans; a field given as None is the span's own."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"),
        *[(s[name] if value is None else value).alias(name) for name, value in fields.items()]))


def _key(text: Column) -> Column:
    """The content key of a text: its MD5 digest, 16 bytes."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def found(docs: DataFrame) -> DataFrame:
    """One row per document: k (the text's key) and the base spans of each kind."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.select("doc_id", _key(F.col("text")).alias("k"),
                       *[base_spans(F.col("text"), kind).alias(kind) for kind in KINDS])


def _hidden(text: Column, spans: Column) -> Column:
    """``text``, at equal length, with ``HIDDEN`` for each character of a span."""
    text = F.translate(text, HIDDEN, " ")

    def step(a: Column, s: Column) -> Column:
        kept = F.substring(text, a["at"] + 1, F.greatest(F.lit(0), s["start"] - a["at"]))
        cover = F.repeat(F.lit(HIDDEN), F.greatest(F.lit(0), s["stop"] - F.greatest(a["at"], s["start"])))
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), F.concat(a["out"], kept, cover).alias("out"))
    walked = F.aggregate(F.sort_array(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return let(walked, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))


#: A term outside the spans; one that touches a span's characters is none.
_WHOLE = f"(?<!{TERM[:-3]}{HIDDEN}]){TERM}(?!{HIDDEN})"


def _texts(docs: DataFrame, once: DataFrame) -> DataFrame:
    """(k, terms, hidden): one row for each different text, with the hashes of its
    terms outside the spans of ``once`` (k, spans) and, where it has spans, the
    text with them hidden.  One exchange of the texts serves all counts."""
    rows = docs.select(_key(F.col("text")).alias("k"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.join(once, "k", "left").dropDuplicates(["k"])
    hidden = F.when(F.col("spans").isNotNull(), _hidden(F.col("text"), F.col("spans")))
    rows = rows.select("k", F.col("text"), hidden.alias("hidden"))
    own = F.regexp_extract_all(F.coalesce("hidden", "text"), F.lit(_WHOLE), F.lit(0))
    terms = F.array_distinct(F.transform(own, lambda w: F.xxhash64(F.lower(w))))
    return rows.select("k", terms.alias("terms"), "hidden")


def _words(texts: DataFrame) -> DataFrame:
    """(k, term, start, stop) of all terms outside the spans of the texts with spans."""
    rows = texts.where(F.col("hidden").isNotNull()).select(
        "k", F.split("hidden", _WHOLE, -1).alias("between"),
        F.regexp_extract_all("hidden", F.lit(_WHOLE), F.lit(0)).alias("found"))
    word = F.posexplode(F.arrays_zip(F.slice("between", F.lit(1), F.size("found")).alias("between"), "found"))
    rows = rows.select("k", word.alias("at", "w")).select(
        "k", "at", F.length("w.between").alias("gap"), F.length("w.found").alias("size"),
        F.xxhash64(F.lower("w.found")).alias("term"))
    stop = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("k").orderBy("at")).cast("int")
    return rows.withColumn("stop", stop).select("k", "term", (F.col("stop") - F.col("size")).alias("start"), "stop")


def disclosing(docs: DataFrame, base: DataFrame) -> DataFrame:
    """(k, start, stop, share) of the terms that reveal a protected entity."""
    every = F.concat(*[_with(kind, kind=F.lit(kind), found=None) for kind in KINDS])
    once = base.select("k", every.alias("spans")).where(F.size("spans") > 0).dropDuplicates(["k"])
    texts = shared_table(_texts(docs, once), "pii-texts")
    n = texts.count()
    held = once.select("k", F.explode("spans").alias("s")).select(
        "k", F.xxhash64("s.kind", F.lower("s.found")).alias("entity")).distinct()
    entities = (held.groupBy("entity").agg(F.count("*").alias("n_e"))
                    .where((F.col("n_e") >= SUPPORT) & (F.col("n_e") < n)))
    held = shared_table(held.join(entities, "entity"), "pii-held")
    words = shared_table(_words(texts.join(held.select("k").distinct(), "k", "left_semi")), "pii-words")
    terms = texts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    information = F.log2(F.lit(float(n)) / F.col("n_e"))

    def share(n_te: str) -> Column:
        return (information + F.log2(F.col(n_te) / F.greatest("n_t", n_te))) / information

    # a term too common to tell even if it stood in all texts of the entity goes at once
    near = (words.select("k", "term").distinct().join(terms, "term").join(held, "k")
                 .where(share("n_e") >= GENERALISE))
    near = shared_table(near.select("k", "entity", "term", "n_e", "n_t"), "pii-near")
    telling = (near.groupBy("entity", "term")
                   .agg(F.count("*").alias("n_te"), F.min("n_e").alias("n_e"), F.min("n_t").alias("n_t"))
                   .where(F.col("n_te") >= SUPPORT).withColumn("share", share("n_te"))
                   .where(F.col("share") >= GENERALISE).select("entity", "term", "share"))
    marked = (near.select("k", "entity", "term").join(telling, ["entity", "term"])
                  .groupBy("k", "term").agg(F.max("share").alias("share")))
    return words.join(marked, ["k", "term"]).select("k", "start", "stop", "share")


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, k, one array of spans per base kind, and ``terms`` [start, stop, share]."""
    base = shared_table(found(docs), "pii-base")
    terms = (disclosing(docs, base).groupBy("k")
             .agg(F.sort_array(F.collect_list(F.struct("start", "stop", "share"))).alias("terms")))
    empty = F.array().cast("array<struct<start:int,stop:int,share:double>>")
    return (base.join(terms, "k", "left")
                .withColumn("terms", F.coalesce("terms", empty)))


def _rewritten(text: Column, marks: Column) -> Column:
    """``text`` with each [start, stop, label] replaced by its label."""
    def step(a: Column, s: Column) -> Column:
        kept = F.substring(text, a["at"] + 1, F.greatest(F.lit(0), s["start"] - a["at"]))
        put = F.when(s["start"] >= a["at"], F.concat(a["out"], kept, s["label"])).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), put.alias("out"))
    walked = F.aggregate(F.sort_array(marks), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return let(walked, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans replaced by labels ([EMAIL], ..; [TERM] for a
    generalised term, nothing for a removed one) and ``n_chars``, if there is
    such a column, brought up to date."""
    marked = spans(docs).dropDuplicates(["k"])
    labels = [_with(kind, label=F.lit(f"[{kind.upper()}]")) for kind in KINDS]
    term = F.transform("terms", lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"),
        F.when(s["share"] >= REMOVE, "").otherwise("[TERM]").alias("label")))
    marks = marked.select("k", F.concat(*labels, term).alias("_marks")).where(F.size("_marks") > 0)
    rows = docs.withColumn("_k", _key(F.col("text"))).join(marks.withColumnRenamed("k", "_k"), "_k", "left")
    text = F.when(F.col("_marks").isNull(), F.col("text")).otherwise(_rewritten(F.col("text"), F.col("_marks")))
    out = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("_marks").isNull(), F.col("n_chars")).otherwise(F.length(text).cast(kind))
    return rows.withColumns(out).select(*docs.columns)
