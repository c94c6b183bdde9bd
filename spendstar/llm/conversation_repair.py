"""Conversation structure repair by iterative-deepening A*.

``damage`` breaks conversations by a keyed rule, ``repair`` mends them: the
cheapest edits that give role initials ``(s?(ua)+)?``.  Edits: Keep 0, Rerole
to user or assistant 1, Delete 2 (required for a blank or duplicate row),
Insert an empty user or assistant turn 5; a truncated row that is not deleted
adds 5.  Among the cheapest edit strings the ASCII-least wins.

Spark orders the turns, finds blank, truncated and repeated ones and packs each
conversation into one symbol a row (the edit string it returns is no shorter).
The search reads these symbols alone: depth first in ASCII edit order under a
cost bound, an admissible sum of what the remaining rows cost at least, and a
table of (row, state) with the largest budget that failed there; the bound
rises to the smallest cost beyond it until a path is accepted.  The state is
what the last kept turn was, so an edit string fixes its path.  Conversations
over ``PIECE`` rows are searched piece by piece, each against the exact cost of
the rest (one backward pass), so the work grows with their rows.

The edits are then applied to the turns in a stream sorted by conversation: a
task holds one conversation's edit string and one batch of turns.

Defined results: nulls in role and text read as one space (initial neither s, u
nor a; a space alone is blank), null turns come first, a null conv_id is a
conversation like any other, ties in turn go by role, then text; a conversation
without rows after the damage needs no edit and costs nothing.  Only the four
columns of ``conversations`` are read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.llm.conversations import ordered, plain

BLANKS = " \t\n\x0b\x0c\r"
PIECE = 64
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: States: nothing kept yet, after a system, user, assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
        "a": {USER: ASSISTANT}, "x": {}}
#: The turn that may follow a state, for Insert and Rerole.
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: What it costs to end in a state: the missing turns are inserted.
END = (0, 2 * INSERT, INSERT, 0)
#: A row's symbol: its initial; upper case if truncated, a digit if it must go.
MUST_GO = {"1": "s", "2": "u", "3": "a", "4": "x"}
_INITIALS = str.maketrans("SUAX1234", "suaxsuax")


# --- the search over one conversation's symbols -------------------------------

def _edits(symbol: str, state: int):
    """(edit, cost, rows read, next state) in ASCII order."""
    yield "D", DELETE, 1, state
    yield "I", INSERT, 0, FOLLOWS[state]
    if symbol not in MUST_GO:
        extra = TRUNCATED if symbol.isupper() else 0
        kept = KEEP[symbol.lower()].get(state)
        if kept is not None:
            yield "K", extra, 1, kept
        yield "R", REROLE + extra, 1, FOLLOWS[state]


def _least(symbol: str) -> int:
    """What a row costs at least, whatever the state."""
    return DELETE if symbol in MUST_GO or symbol.isupper() else 0


def _search(piece: str, entry: int, beyond: tuple, last: bool) -> tuple[str, int]:
    """(edits, state) of the first cheapest path through ``piece``; ``beyond``:
    the exact cost from each state after it.  Inserts at the end belong to the
    next piece, or to this one if it is the ``last``."""
    n = len(piece)
    need = [min(beyond)] * (n + 1)
    for i in range(n - 1, -1, -1):
        need[i] = need[i + 1] + _least(piece[i])
    bound = need[0]
    while True:
        failed: dict[tuple[int, int], int] = {}
        over = [1 << 60]

        def walk(i: int, state: int, spent: int):
            at_end = i == n
            f = spent + (beyond[state] if at_end else need[i])
            if f > bound:
                over[0] = min(over[0], f)
                return None
            if at_end and not (last and END[state]):
                return "", state
            if failed.get((i, state), -1) >= bound - spent:
                return None
            steps = [("I", INSERT, 0, FOLLOWS[state])] if at_end else _edits(piece[i], state)
            for edit, cost, read, then in steps:
                found = walk(i + read, then, spent + cost)
                if found is not None:
                    return edit + found[0], found[1]
            failed[i, state] = bound - spent
            return None

        found = walk(0, entry, 0)
        if found is not None:
            return found
        bound = over[0]


def _rest(symbols: str) -> list[tuple]:
    """The exact cost to the end from each state, at every piece's border."""
    costs, out = list(END), [END]
    for i in range(len(symbols) - 1, 0, -1):
        row = [min(c + costs[to] for e, c, _, to in _edits(symbols[i], s) if e != "I") for s in range(4)]
        for _ in range(3):  # turns inserted before the row
            row = [min(row[s], INSERT + row[FOLLOWS[s]]) for s in range(4)]
        costs = row
        if i % PIECE == 0:
            out.append(tuple(costs))
    return out[::-1]


def cost_of(edits: str, symbols: str) -> int:
    total, i = 0, 0
    for e in edits:
        total += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[e]
        if e != "I":
            total += TRUNCATED * (e != "D" and symbols[i].isupper())
            i += 1
    return total


def cheapest(symbols: str) -> str:
    """The ASCII-least cheapest edit string of one conversation."""
    out, state, rest = [], START, _rest(symbols)
    for k, beyond in enumerate(rest):
        edits, state = _search(symbols[k * PIECE:(k + 1) * PIECE], state, beyond, k == len(rest) - 1)
        out.append(edits)
    return "".join(out)


_cheapest = lru_cache(maxsize=1 << 16)(cheapest)


def illegal_pairs(symbols: str) -> int:
    initials = symbols.translate(_INITIALS)
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


# --- Spark -------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """Rows broken by crc32(``conv_id:turn``) % 20: 0 drops a row, 1 empties its
    text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user."""
    def key(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = plain(conversations, " ").withColumn(
        "_rule", F.crc32(F.concat(key("conv_id"), F.lit(":"), key("turn"))) % 20)
    rule = F.col("_rule")
    return rows.where(rule != 0).select(
        "conv_id", "turn",
        F.when(rule == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(rule == 1, F.lit("")).when(rule == 2, F.translate("text", ".!?", ""))
         .otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(rule == 3, 2).otherwise(1))).alias("_copy")
    ).drop("_copy")


def _with_symbols(turns: DataFrame) -> DataFrame:
    """conv_id, turn, at, fault, symbol of each row.  A duplicate is a row whose
    (conv_id, role, text) has a smaller ``at``: the smallest of each digest is
    aggregated before the shuffle and joined back by ``at``, which is unique."""
    same = F.md5(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                          F.length("role").cast("string"), F.lit(":"), "role", "text"))
    first = turns.groupBy(same.alias("_same")).agg(F.min("at").alias("at")) \
                 .select("at", F.lit(True).alias("_first"))
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = turns.select("conv_id", "turn", "at", F.substring("role", 1, 1).alias("_i"),
                        (end == "").alias("_blank"),
                        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("_cut"))
    rows = rows.join(first, "at", "left").select(
        "conv_id", "turn", "at",
        F.when(F.col("_i").isin("s", "u", "a"), F.col("_i")).otherwise(F.lit("x")).alias("_i"),
        F.when(F.col("_blank"), "blank").when(F.col("_first").isNull(), "duplicate")
         .when(F.col("_cut"), "truncated").alias("fault"))
    return rows.withColumn(
        "symbol", F.when(F.col("fault") == "truncated", F.upper("_i"))
                   .when(F.col("fault").isNotNull(), F.translate("_i", "suax", "1234"))
                   .otherwise(F.col("_i"))).drop("_i")


def _packed(rows: DataFrame) -> DataFrame:
    """conv_id and its symbols in order: first 2^16 positions at a time, then
    the pieces, so that a long conversation is packed by many tasks."""
    def joined(order, value):
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, value))),
                                        lambda x: x[value]), "").alias("symbols")
    pieces = rows.groupBy("conv_id", F.shiftright("at", 16).alias("_piece")).agg(joined("at", "symbol"))
    return pieces.groupBy("conv_id").agg(joined("_piece", "symbols"))


def _plan(batches):
    """conv_id, symbols -> conv_id, audit, cost, illegal."""
    for batch in batches:
        symbols = batch.column("symbols").to_pylist()
        audits = [_cheapest(s) if len(s) <= PIECE else cheapest(s) for s in symbols]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(audits, pa.string()),
             pa.array([cost_of(a, s) for a, s in zip(audits, symbols)], pa.int64()),
             pa.array([illegal_pairs(s) for s in symbols], pa.int64())],
            names=["conv_id", "audit", "cost", "illegal"])


def _apply(batches):
    """Turns after their conversation's edit string (``at`` null) -> repaired turns."""
    edits, done, state, pos = "", 0, START, 0
    names = ["conv_id", "pos", "edit", "role", "text"]

    def inserts(out, conv):
        nonlocal done, state, pos
        while done < len(edits) and edits[done] == "I":
            state = FOLLOWS[state]
            out.append((conv, pos, "I", ROLE[state], ""))
            done, pos = done + 1, pos + 1

    for batch in batches:
        out: list[tuple] = []
        for conv, at, role, text in zip(*(batch.column(c).to_pylist()
                                          for c in ("conv_id", "at", "role", "text"))):
            if at is None:
                edits, done, state, pos = text, 0, START, 0
            else:
                edit, done = edits[done], done + 1
                if edit != "D":
                    state = FOLLOWS[state] if edit == "R" else KEEP[role[:1]][state]
                    out.append((conv, pos, edit, ROLE[state] if edit == "R" else role, text))
                    pos += 1
            inserts(out, conv)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(
                zip(*out) if out else [()] * 5,
                (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))], names=names)


def _digest(batches):
    """Repaired turns in order -> conv_id, sha256 of their ``role:text`` lines."""
    now, conv, some = None, None, False
    for batch in batches:
        done = []
        for c, pos, role, text in zip(*(batch.column(n).to_pylist()
                                        for n in ("conv_id", "pos", "role", "text"))):
            if pos == 0:
                if some:
                    done.append((conv, now.hexdigest()))
                now, conv, some = hashlib.sha256(), c, True
            else:
                now.update(b"\n")
            now.update(f"{role}:{text}".encode())
        yield _digests(done)
    if some:
        yield _digests([(conv, now.hexdigest())])


def _digests(rows: list):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                       pa.array([r[1] for r in rows], pa.string())],
                                      names=["conv_id", "repaired_sha256"])


class Repair:
    """The repair of ``rows`` (conv_id, turn, role, text): ``plans`` (conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit), one row for each
    conversation that has rows, and ``turns`` (conv_id, pos, edit, role, text),
    the repaired conversations."""

    def __init__(self, rows: DataFrame):
        from spendstar.llm.common import shared_table
        source = ordered(plain(rows, " "), "repair-turns")
        symbols = shared_table(_with_symbols(source), "repair-symbols")
        facts = symbols.groupBy("conv_id").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"),
                       F.lit(0)).alias("gaps"),
            *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
        plans = _packed(symbols).mapInArrow(_plan, "conv_id long, audit string, cost long, illegal long")
        plans = shared_table(plans, "repair-plans")
        self.plans = plans.join(facts.withColumnRenamed("conv_id", "_id"),
                                F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id")
        stream = source.select("conv_id", "at", "role", "text").unionByName(
            plans.select("conv_id", F.lit(None).cast("long").alias("at"),
                         F.lit("").alias("role"), F.col("audit").alias("text")))
        self.turns = (stream.repartition("conv_id").sortWithinPartitions("conv_id", "at")
                      .mapInArrow(_apply, "conv_id long, pos long, edit string, role string, text string"))

    def digests(self) -> DataFrame:
        """conv_id, repaired_sha256: one pass over the sorted stream."""
        return self.turns.mapInArrow(_digest, "conv_id long, repaired_sha256 string")


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations`` on the repair of ``rows``."""
    fixed = Repair(rows)
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (fixed.plans, fixed.digests()):
        part = part.withColumnRenamed("conv_id", "_id")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest()))
                       .alias("repaired_sha256"))
