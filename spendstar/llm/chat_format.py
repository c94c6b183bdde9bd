"""Chat formatting of reply trees, in DataFrame functions alone.

A tree's messages name their parent.  Iterative self-joins enumerate the
root-to-leaf paths: first, pointers of messages that are their parent's only
reply double their reach until each knows the head of its unbranched stretch
(so a long thread takes logarithmic rounds, not one join a turn), then whole
stretches are joined to the stretches that reply to them, once for each level
of branching.  Branches are ranked by their mean message score (ties: smaller
leaf id), and each chosen path becomes one conversation.

Template: a turn is ``<s>role``, a line break, ``text</s>``.  A control string
(``CONTROL``) inside a text gets a backslash after its first character, and one
that already has backslashes there gets one more, so nothing else in a text
changes and ``unescape`` gives it back exactly; in a role ``% < [`` and line
breaks are percent-coded.  The loss mask lists the (start, length) of assistant
texts in the formatted string, in code points.

Defined results: null role and text are empty, null turns come first, ties in
turn go by role, then text, repeated rows are turns of their own, a null tree id
is a tree like any other, a message whose parent is missing is a root, messages
on a cycle belong to no path.  Only the named columns are read.  An empty table
gives no conversation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendstar.llm.common import shared_table
from spendstar.llm.conversations import numbered_turns, plain

OPEN, CLOSE = "<s>", "</s>"
#: No text may hold one of these as it stands.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
_CODED = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"), ("[", "%5B"))


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<(\\*+)(/?s>)", r"<\\$1$2")
    return F.regexp_replace(text, r"\[(\\*+)(/?INST\])", r"[\\$1$2")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<\\(\\*+)(/?s>)", r"<$1$2")
    return F.regexp_replace(text, r"\[\\(\\*+)(/?INST\])", r"[$1$2")


def escape_role(role: Column) -> Column:
    return reduce(lambda c, x: F.replace(c, F.lit(x[0]), F.lit(x[1])), _CODED, role)


def unescape_role(role: Column) -> Column:
    return reduce(lambda c, x: F.replace(c, F.lit(x[1]), F.lit(x[0])), _CODED[::-1], role)


# --- reply trees ----------------------------------------------------------------

def _parent(key: str, message: str = "message_id") -> Column:
    """The join condition parent_id = key.  Roots match nothing; the first
    equality deals them by their own id, not all to one task."""
    return (F.coalesce(F.col("parent_id"), F.col(message)) == F.col(key)) & F.col("parent_id").isNotNull()


def _stretches(links: DataFrame) -> DataFrame:
    """message_id, head, dist: each message's place in its unbranched stretch."""
    replies = links.groupBy(F.col("parent_id").alias("_parent")).agg(F.count("*").alias("_n"))
    hops = links.join(replies, _parent("_parent"), "left").select(
        "message_id", F.when(F.col("_n") == 1, F.col("parent_id")).alias("to"))
    hops = shared_table(hops.select(
        "message_id", F.coalesce("to", "message_id").alias("to"),
        F.when(F.col("to").isNull(), 0).otherwise(1).cast("long").alias("dist"),
        F.col("to").isNull().alias("found")), "tree-hops")
    done, open_ = [hops.where("found")], hops.where("not found")
    left, most = open_.count(), hops.count().bit_length() + 1
    while left and most:  # the rounds end even where messages form a cycle
        known = reduce(DataFrame.unionByName, [*done, open_]).select(
            F.col("message_id").alias("_at"), F.col("to").alias("_to"),
            F.col("dist").alias("_dist"), F.col("found").alias("_found"))
        step = shared_table(open_.join(known, F.col("to") == F.col("_at")).select(
            "message_id", F.col("_to").alias("to"), (F.col("dist") + F.col("_dist")).alias("dist"),
            F.col("_found").alias("found")), "tree-hops")
        done, open_ = [*done, step.where("found")], step.where("not found")
        left, most = open_.count(), most - 1
    return reduce(DataFrame.unionByName, done).select("message_id", F.col("to").alias("head"), "dist")


def branches(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every root-to-leaf path (tree, leaf, score, path: the heads of its
    stretches; ``tree`` is its root, ``leaf`` the head of its last stretch,
    ``score`` the mean score of its messages) and the members of the stretches
    (head, dist, message_id)."""
    links = messages.select("message_id", "parent_id", F.col("score").cast("double").alias("score"))
    present = links.select(F.col("message_id").alias("_there"))
    links = links.join(present, _parent("_there"), "left") \
                 .select("message_id", F.col("_there").alias("parent_id"), "score")
    places = shared_table(_stretches(links).join(links, "message_id"), "tree-places")
    stretch = places.groupBy("head").agg(
        F.sum(F.coalesce("score", F.lit(0.0))).alias("score"), F.count("*").alias("turns"),
        F.max(F.when(F.col("dist") == 0, F.col("parent_id"))).alias("parent_id"))
    above = places.select(F.col("message_id").alias("_answers"), F.col("head").alias("above"))
    stretch = shared_table(stretch.join(above, _parent("_answers", "head"), "left").drop("_answers"),
                           "tree-stretches")
    under = stretch.where(F.col("above").isNotNull()).select(
        "above", F.col("head").alias("_head"), F.col("score").alias("_score"), F.col("turns").alias("_turns"))
    answered = under.select(F.col("above").alias("head")).distinct()
    front, found = stretch.where(F.col("above").isNull()).select(
        F.col("head").alias("tree"), "head", "score", "turns", F.array("head").alias("path")), []
    while True:
        found.append(front.join(answered, "head", "left_anti"))
        front = shared_table(front.join(under, F.col("head") == F.col("above")).select(
            "tree", F.col("_head").alias("head"), (F.col("score") + F.col("_score")).alias("score"),
            (F.col("turns") + F.col("_turns")).alias("turns"),
            F.array_append("path", F.col("_head")).alias("path")), "tree-paths")
        if front.isEmpty():
            break
    paths = reduce(DataFrame.unionByName, found).select(
        "tree", F.col("head").alias("leaf"), (F.col("score") / F.col("turns")).alias("score"), "path")
    return paths, places.select("head", "dist", "message_id")


def format_trees(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """The ``keep`` best branches of each tree (null: all) as conversations:
    tree_id, leaf, rank, score, n_turns, formatted, loss_mask.

    ``messages``: tree_id, message_id (unique), parent_id (null: a root), role,
    text, score.  A tree with several roots is several trees of one tree_id.
    """
    paths, places = branches(messages)
    best = Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf")
    paths = paths.withColumn("rank", F.row_number().over(best))
    if keep is not None:
        paths = paths.where(F.col("rank") <= keep)
    members = paths.select("leaf", "rank", "score", F.posexplode("path").alias("_k", "head")) \
                   .join(places, "head")
    turns = members.join(messages.select("message_id", "tree_id", "role", "text"), "message_id").select(
        "leaf", "rank", "score", "tree_id", "_k", "dist", F.coalesce("role", F.lit("")).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("_text"))
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    turns = turns.withColumn("_head", head) \
                 .withColumn("_turn", F.concat("_head", "_text", F.lit(CLOSE)))
    before = F.sum(F.char_length("_turn").cast("long")).over(
        Window.partitionBy("leaf").orderBy("_k", "dist").rowsBetween(Window.unboundedPreceding, -1))
    turns = turns.withColumn("_start", F.coalesce(before, F.lit(0)) + F.char_length("_head"))
    mask = F.when(F.col("role") == "assistant",
                  F.struct(F.col("_start").alias("start"),
                           F.char_length("_text").cast("long").alias("length")))
    whole = turns.groupBy("leaf").agg(
        F.first("tree_id").alias("tree_id"), F.first("rank").alias("rank"), F.first("score").alias("score"),
        F.sort_array(F.collect_list(F.struct("_k", "dist", "_turn", mask.alias("_mask")))).alias("_turns"))
    return whole.select(
        "tree_id", "leaf", "rank", "score", F.size("_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("_turns", lambda t: t["_turn"]), "").alias("formatted"),
        F.transform(F.filter("_turns", lambda t: t["_mask"].isNotNull()),
                    lambda t: t["_mask"]).alias("loss_mask"))


def as_trees(conversations: DataFrame) -> DataFrame:
    """``conversations`` as reply trees: each turn replies to the one before it."""
    rows = shared_table(numbered_turns(plain(conversations), "chat-turns"), "chat-messages")
    before = rows.select((F.col("row_no") + 1).alias("message_id"),
                         F.col("row_no").alias("_before"), F.col("conv_id").alias("_conv"))
    return rows.withColumnRenamed("row_no", "message_id").join(before, "message_id", "left").select(
        F.col("conv_id").alias("tree_id"), "message_id",
        F.when(F.col("_conv").eqNullSafe(F.col("conv_id")), F.col("_before")).alias("parent_id"),
        "role", "text", F.lit(0.0).alias("score"))


# --- reading back -----------------------------------------------------------------

def read_back(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""
    turns = F.filter(F.split(formatted, CLOSE), lambda t: t != "")
    head = F.lit(len(OPEN) + 1)
    return F.transform(turns, lambda t: F.struct(
        unescape_role(F.substr(F.substring_index(t, "\n", 1), head)).alias("role"),
        unescape(F.substr(t, F.char_length(F.substring_index(t, "\n", 1)) + 2)).alias("text")))


def under_mask(formatted: Column, loss_mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss_mask, lambda m: unescape(
        F.substr(formatted, (m["start"] + 1).cast("int"), m["length"].cast("int")))), "")
