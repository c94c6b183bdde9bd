"""Near-duplicates by MinHash with an LSH forest.

A document's set are its distinct 5-word shingles.  Equal sets meet by digest
and are represented by one of them.  A signature of 72 minima is read in 24
orders (rotations by three values); in each order the representatives are
sorted, so that neighbours are those with the longest common prefix.  Regions
(three leading values shared) of one member drop out; in the others every
member is compared with the ``NEIGHBOURS`` members that follow it, which is
every pair of a small region and, in a crowded region, the pairs that agree to
the greatest depth: the depth adapts to each region.  A pair of similarity 0.75
shares a region in some order with probability 1 - 2e-6.

Candidates are ranked by signature agreement.  Each representative's best ones
are confirmed first on the full sets; then all others whose documents are not
yet in one component.  Crowded regions that still hold several components are
then compared whole, on the full sets, by blocks of their members: a task counts
the intersections of a pair of blocks and hands over a spanning forest of the
links between components, so neither pairs nor shared shingles become rows.
Components come from alternating large-star and small-star rounds over tables.

The texts whose sets are needed are read where they lie: a bitmap of hashed ids
(``BITMAP`` bits, whatever the number of ids) tells the others apart, and only
the sets are shuffled.

Null, empty or blank texts have no shingles and link with nothing.  Rows that
repeat a doc_id are one node.  Rows without doc_id are kept and unlinked
(component null).
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendstar.llm.common import (buffers, doc_slices, lowered, shared_table, shingle_hashes)

SIZE = 72
DEPTH = 3
ORDERS = SIZE // DEPTH
SORT_DEPTH = 12
NEIGHBOURS = 8
#: Least agreement of signatures for a check on the sets: five standard
#: deviations below the mean of 54 at similarity 0.75.
LEAST_AGREEMENT = 36
BEST = 2
#: A block of a crowded region holds about so many members and so many shingles.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
#: Shingles with at most so many holders in a pair of blocks are counted pair by pair.
FEW = 8
#: Bits of the map of wanted ids (2 MB).
BITMAP = 1 << 24

_RNG = np.random.default_rng(20250607)
_MASK = _RNG.integers(0, 2**32, SIZE, dtype=np.uint32)
_MULT = _RNG.integers(0, 2**32, SIZE, dtype=np.uint32) | np.uint32(1)


def distinct_shingles(data: np.ndarray, offsets: np.ndarray):
    """One sorted array of distinct shingle hashes per text."""
    hashes, to = shingle_hashes(lowered(data), offsets)
    out = []
    for a, b in zip(to, to[1:]):
        own = np.sort(hashes[a:b])
        out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if b > a else own)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, SIZE) minima of keyed 32-bit hashes; empty sets give zeros."""
    out = np.zeros((len(sets), SIZE), dtype=np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    for a in range(0, len(full), 256):
        part = full[a:a + 256]
        low = np.concatenate([sets[i] for i in part])
        low = (low >> np.uint64(32)).astype(np.uint32) ^ low.astype(np.uint32)
        heads = np.concatenate([[0], np.cumsum([len(sets[i]) for i in part])[:-1]])
        for j in range(SIZE):
            out[part, j] = np.minimum.reduceat((low ^ _MASK[j]) * _MULT[j], heads)
    return out


def _signed(batches):
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        for i, j in doc_slices(offsets):
            sets = distinct_shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            sig = signatures(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                           for s in sets], pa.binary()),
                 pa.array([r.tobytes() for r in sig], pa.binary())],
                names=["doc_id", "n_shingles", "digest", "signature"])


def _sets(bits: np.ndarray):
    """id, digest, shingles of the texts whose id may be wanted (``slot`` is set)."""
    def run(batches):
        for batch in batches:
            slot = batch.column("slot").to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array((bits[slot >> 3] >> (slot & 7)) & 1 == 1))
            data, offsets = buffers(batch.column("text"))
            for i, j in doc_slices(offsets):
                sets = distinct_shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                flat = np.concatenate(sets).view(np.int64)
                for a, b in doc_slices(cuts, 1 << 20):
                    part = pa.ListArray.from_arrays(pa.array(cuts[a:b + 1] - cuts[a], pa.int32()),
                                                    pa.array(flat[cuts[a]:cuts[b]]))
                    digests = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets[a:b]]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(i + a, b - a), pa.array(digests, pa.binary()), part],
                        names=["id", "digest", "shingles"])
    return run


def _slot(c: str):
    return F.pmod(F.xxhash64(c), F.lit(BITMAP))


def _bitmap(ids: DataFrame) -> np.ndarray:
    """``BITMAP`` bits: the slots of the ids.  At most BITMAP / 32,768 rows of 4 KB."""
    slot = _slot("id") + 1
    rows = ids.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    out = np.zeros(BITMAP // 8, dtype=np.uint8)
    for r in rows:
        out[(r.part - 1) * 4096:r.part * 4096] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def _sets_of(text: DataFrame, ids: DataFrame) -> DataFrame:
    """id, shingles: each different set of the texts of ``ids`` (id), once."""
    found = text.where("doc_id is not null").select("doc_id", "text", _slot("doc_id").alias("slot")) \
                .mapInArrow(_sets(_bitmap(ids)), "id long, digest binary, shingles array<long>")
    return found.join(ids, "id", "left_semi").dropDuplicates(["id", "digest"]).select("id", "shingles")


def _pairs_in_order(reach: int):
    """Compares each sorted row with the ``reach`` rows that follow in its region."""
    def run(batches):
        held = None
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            region = batch.column("region").to_numpy(zero_copy_only=False)
            data, _ = buffers(batch.column("signature"))
            new = [ids, region, data.reshape(-1, SIZE * 4).copy().view(np.uint32)]
            known = 0 if held is None else len(held[0])
            if known:
                new = [np.concatenate([h, n]) for h, n in zip(held, new)]
            ids, region, sig = new
            agree = np.zeros((len(ids), reach), dtype=np.int32)
            for step in range(1, reach + 1):
                a = np.arange(max(0, known - step), len(ids) - step)  # earlier ones are done
                a = a[region[a] == region[a + step]]
                agree[a, step - 1] = (sig[a] == sig[a + step]).sum(axis=1)
            a, step = np.nonzero(agree >= LEAST_AGREEMENT)
            x, y = ids[a], ids[a + step + 1]
            held = [n[-reach:] for n in new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)),
                 pa.array(agree[a, step])], names=["a", "b", "agree"])
    return run


def _unfinished(stars: DataFrame) -> bool:
    """Whether some id has two smaller neighbours, or a smaller and a larger one."""
    ends = F.explode(F.array(*[F.struct(F.col(c).alias("id"), F.lit(c == "a").cast("int").alias("leaf"))
                               for c in ("a", "b")]))
    roles = (stars.select(ends.alias("e")).groupBy("e.id")
                  .agg(F.sum("e.leaf").alias("leaf"), F.min("e.leaf").alias("low")))
    return roles.where("leaf > 1 or (leaf = 1 and low = 0)").limit(1).count() > 0


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(id, comp): the smallest id reachable over ``edges`` (a, b), for every id
    in them.  Alternating large-star and small-star rounds until every id is
    either a centre or linked with its centre alone; hot nodes are pre-aggregated
    before each shuffle."""
    stars = shared_table(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while _unfinished(stars):
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        stars = shared_table(
            small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), name)
    return (stars.select(F.col("a").alias("id"), F.col("b").alias("comp"))
                 .union(stars.select(F.col("b").alias("id"), F.col("b").alias("comp"))).distinct())


def _merged(comps: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``comps`` after ``links`` (a, b) more: only the graph of components that
    they tie is closed, not all links again."""
    a = comps.select(F.col("id").alias("a"), F.col("comp").alias("ca"))
    b = comps.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
    ties = links.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    up = components(ties)
    new = up.join(comps, "id", "left_anti").select("id", F.col("id").alias("comp"))
    up = up.select(F.col("id").alias("comp"), F.col("comp").alias("top"))
    out = comps.union(new).join(up, "comp", "left")
    return shared_table(out.select("id", F.coalesce("top", "comp").alias("comp")), name)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with 100 * intersection >= 75 * union of their full sets."""
    x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(x, "a").join(y, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return (both.select("a", "b", shared.alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
                .where("100 * i >= 75 * (n - i)").select("a", "b"))


def _regions(reps: DataFrame) -> DataFrame:
    """One row per representative and order in which its region has other members.
    Signatures join the rows that are left, not the exploded ones."""
    order = F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1)))
    rows = reps.select("id", "signature", order.alias("tree"))
    lead = F.expr(f"substring(signature, tree * {4 * DEPTH} + 1, {4 * DEPTH})")
    rows = rows.select("id", "tree", F.xxhash64("tree", lead).alias("region"))
    crowded = rows.groupBy("region").agg(F.count("*").alias("members")).where("members > 1")
    return rows.join(crowded, "region").join(reps, "id")


def _sorted_pairs(rows: DataFrame, reach: int) -> DataFrame:
    key = F.expr(f"substring(concat(signature, signature), tree * {4 * DEPTH} + 1, {4 * SORT_DEPTH})")
    order = ["tree", "key", "id"]
    rows = rows.withColumn("key", key)
    small = F.col("members") <= reach + 1  # kept whole, so that no pair is cut by a partition's edge
    whole = rows.where(small).repartition("region").sortWithinPartitions("region", "key", "id")
    rows = rows.where(~small).repartitionByRange(*order).sortWithinPartitions(*order).unionByName(whole)
    pairs = (rows.select("id", "region", "signature")
                 .mapInArrow(_pairs_in_order(reach), "a long, b long, agree int"))
    return pairs.groupBy("a", "b").agg(F.max("agree").alias("agree"))


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose ends are not yet in one component."""
    a = comps.select(F.col("id").alias("a"), F.col("comp").alias("ca"))
    b = comps.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
    both = pairs.join(a, "a", "left").join(b, "b", "left")
    return both.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(*pairs.columns)


def _intersections(n: int, row: np.ndarray, token: np.ndarray) -> np.ndarray:
    """(n, n) sizes of the intersections of n sets, given as (row, token) entries."""
    order = np.lexsort((row, token))
    row, token = row[order], token[order]
    heads = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, int)
    sizes = np.diff(np.concatenate([heads, [len(token)]]))
    pairs = [np.zeros(0, dtype=np.int64)]
    for f in range(2, FEW + 1):  # few holders: pair by pair
        held = row[heads[sizes == f][:, None] + np.arange(f)].astype(np.int64)
        pairs += [held[:, i] * n + held[:, j] for i in range(f) for j in range(i + 1, f)]
    out = np.bincount(np.concatenate(pairs), minlength=n * n).reshape(n, n).astype(np.float32)
    out += out.T
    many = np.flatnonzero(sizes > FEW)
    for k in range(0, len(many), 2048):  # many holders: a matrix product
        part = many[k:k + 2048]
        at = np.repeat(heads[part], sizes[part]) + _ramps(sizes[part])
        block = np.zeros((n, len(part)), dtype=np.float32)
        block[row[at], np.repeat(np.arange(len(part)), sizes[part])] = 1
        out += block @ block.T
    return out


def _ramps(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _forest(alike: np.ndarray, comp: np.ndarray):
    """Rows (x, y) of a spanning forest of the components that ``alike`` links."""
    up: dict[int, int] = {}

    def root(c):
        while up.get(c, c) != c:
            up[c] = up.get(up[c], up[c])
            c = up[c]
        return c

    out = []
    for x in np.flatnonzero(alike.any(axis=1)):
        ys = np.flatnonzero(alike[x])
        for y in ys[np.unique(comp[ys], return_index=True)[1]]:
            a, b = root(int(comp[x])), root(int(comp[y]))
            if a != b:
                up[max(a, b)] = min(a, b)
                out.append((x, y))
    return out


def _block_links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The links between components of one pair of blocks of a region."""
    ids, comp, piece = (table.column(c).to_numpy() for c in ("id", "comp", "piece"))
    lists = table.column("shingles").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    token = lists.flatten().to_numpy(zero_copy_only=False)
    n = len(ids)
    shared = _intersections(n, np.repeat(np.arange(n), sizes), token)
    alike = 100 * shared >= 75 * (sizes[:, None] + sizes[None, :] - shared)
    alike &= comp[:, None] != comp[None, :]
    if key[1].as_py() != key[2].as_py():  # pairs within a block are another task's
        alike &= piece[:, None] != piece[None, :]
    links = _forest(np.triu(alike), comp)
    x, y = (np.array([r[i] for r in links], dtype=np.int64) for i in (0, 1))
    return pa.table([pa.array(np.minimum(ids[x], ids[y])), pa.array(np.maximum(ids[x], ids[y]))],
                    names=["a", "b"])


def _crowd_links(rows: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): in every crowded region that holds several components, links that
    tie all components that any two of its members tie."""
    rows = (rows.where(F.col("members") > NEIGHBOURS + 1).select("id", "region", "n").join(comps, "id", "left")
                .withColumn("comp", F.coalesce("comp", "id")))
    mixed = rows.groupBy("region").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"),
        F.expr(f"1 + greatest(count(*) div {BLOCK}, sum(n) div {BLOCK_SHINGLES})").alias("blocks"))
    mixed = mixed.where("lo <> hi").select("region", "blocks")
    piece = F.pmod(F.xxhash64("id"), F.col("blocks"))
    rows = rows.join(mixed, "region").select("region", "id", "comp", "blocks", piece.alias("piece"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = rows.select("*", other.alias("other")).select(
        "region", F.least("piece", "other").alias("a"), F.greatest("piece", "other").alias("b"),
        "id", "comp", "piece")
    return (rows.join(sets, "id").groupBy("region", "a", "b")
                .applyInArrow(_block_links, "a long, b long").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = shared_table(text.mapInArrow(
        _signed, "doc_id long, n_shingles long, digest binary, signature binary"), "minhash-signed")
    linked = signed.where("doc_id is not null and digest is not null")
    reps = linked.groupBy("digest").agg(F.min("doc_id").alias("id"), F.min("signature").alias("signature"),
                                          F.min("n_shingles").alias("n"))
    reps = shared_table(reps, "minhash-reps")
    # several sets under one id (a repeated doc_id) are tied by the id itself
    rows = shared_table(_regions(reps.select("id", "signature", "n")), "minhash-regions")
    pairs = shared_table(_sorted_pairs(rows, NEIGHBOURS), "minhash-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).union(
        rows.where(F.col("members") > NEIGHBOURS + 1).select("id")).distinct()
    sets = shared_table(_sets_of(text, shared_table(wanted, "minhash-wanted")), "minhash-sets")

    rank = [F.row_number().over(Window.partitionBy(c).orderBy(F.desc("agree"), o))
            for c, o in (("a", "b"), ("b", "a"))]  # at most 2 * NEIGHBOURS * ORDERS rows an id
    best = shared_table(pairs.withColumn("ra", rank[0]).withColumn("rb", rank[1])
                             .withColumn("best", F.least("ra", "rb") <= BEST), "minhash-ranked")
    links = shared_table(_confirmed(best.where("best"), sets), "minhash-links")
    comps = shared_table(components(links), "minhash-comps")
    more = shared_table(_confirmed(_apart(best.where("not best"), comps), sets), "minhash-more")
    comps = _merged(comps, more, "minhash-comps")
    # members of crowded regions that are apart even then
    last = shared_table(_crowd_links(rows, comps, sets), "minhash-last")
    comps = _merged(comps, last, "minhash-comps")

    rep_of = linked.join(reps.select("digest", "id"), "digest") \
                   .select("doc_id", "id").distinct()
    repeated = rep_of.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    if repeated:  # an id with several texts ties their sets: close over those links, too
        same = rep_of.where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
        comps = _merged(comps, same, "minhash-comps")
        by_doc = comps.select(F.col("id").alias("doc_id"), "comp")
    else:
        by_doc = rep_of.join(comps, "id", "left").select("doc_id", F.coalesce("comp", "id").alias("comp"))
    out = signed.select("doc_id", "n_shingles").join(by_doc, "doc_id", "left")
    component = F.coalesce("comp", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their group (rows without id stay)."""
    dropped = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
