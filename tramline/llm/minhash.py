"""Near-duplicates by MinHash with tensored banding, confirmed on full sets.

Two collections of ``HALVES`` half-bands of ``ROWS`` minhashes each are
computed for a set. Every pair of one half-band of each collection is the
key of a table: HALVES * HALVES tables of bands of 2 * ROWS minhashes, from
2 * HALVES * ROWS minhashes instead of HALVES * HALVES * 2 * ROWS. Two sets
of similarity s share no table cell with a probability below
2 * (1 - s**ROWS)**HALVES: 2e-5 at 0.75, 1e-7 at 0.85.

Equal sets are one node. Nodes that share a cell meet in the group of its
first half-band and are compared there by a sketch of ``SKETCH`` minhashes.
Of pairs whose sketches leave no doubt a group hands on a spanning forest,
of doubtful pairs all between different trees; these few pairs are confirmed
on the full sets, and the confirmed links make the components. Groups of
more than ``BLOCK`` members are first contracted: each member is confirmed
against the smallest node of its cells, groups that are one component then
are done, and the others are compared block by block. So thousands of near
copies cost about as many confirmations as there are copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import bounded_batches, stored, text_chunks
from tramline.llm.components import components

SHINGLE = 5
PERCENT = 75
ROWS = 2
HALVES = 14
SKETCH = 1024
BLOCK = 512                      # members of a group compared with each other at a time
# Of SKETCH minhashes of similarity 0.75 fewer agree than the first with a
# probability of 4e-6, of less than 0.75 more than the second with 2e-8. The
# looks at their first parts, 4 deviations wide, lose less than 1e-8 more.
DOUBTFUL, SURE = 706, 845

_RNG = np.random.default_rng(20240607)
_XOR = _RNG.integers(0, 2**64, 2 * HALVES * ROWS, dtype=np.uint64)
_ODD = _RNG.integers(0, 2**64, 2 * HALVES * ROWS, dtype=np.uint64) | np.uint64(1)
_POWERS = _RNG.integers(0, 2**64, SHINGLE, dtype=np.uint64) | np.uint64(1)
_XOR32 = _RNG.integers(0, 2**32, SKETCH, dtype=np.uint32)
_ODD32 = _RNG.integers(0, 2**32, SKETCH, dtype=np.uint32) | np.uint32(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes."""
    split = [t.lower().split() for t in texts]  # bytes: only A-Z are lowered
    words = [w for s in split for w in s]
    seen = dict.fromkeys(words)
    own = {w: xxhash.xxh3_64_intdigest(w) for w in seen}
    hashes = np.fromiter(map(own.__getitem__, words), np.uint64, len(words))
    rolled = np.zeros(max(len(words) - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE):
        rolled += hashes[k:k + len(rolled)] * _POWERS[k]
    rolled = _mix(rolled)
    out, at = [], 0
    for s in split:
        n = len(s)
        if n >= SHINGLE:
            out.append(np.unique(rolled[at:at + n - SHINGLE + 1]))
        elif n:
            short = np.uint64(n)
            with np.errstate(over="ignore"):
                for h in hashes[at:at + n]:
                    short = (short ^ h) * _POWERS[0]
            out.append(_mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def half_bands(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 2 * HALVES numbers for each set; those of empty sets mean nothing."""
    flat = np.concatenate([*sets, np.zeros(1, np.uint64)])  # a last element for reduceat
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    bands = np.zeros((len(sets), 2 * HALVES), np.uint64)
    for i in range(2 * HALVES):
        band = np.full(len(sets), i, np.uint64)
        for k in range(i * ROWS, (i + 1) * ROWS):
            least = np.minimum.reduceat((flat ^ _XOR[k]) * _ODD[k], starts)
            band = _mix(band ^ least) + least
        bands[:, i] = band
    return bands


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A byte of each of SKETCH minhashes for each set; those of empty sets mean nothing."""
    flat = (np.concatenate([*sets, np.zeros(1, np.uint64)]) >> np.uint64(32)).astype(np.uint32)
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    out = np.empty((len(sets), SKETCH), np.uint8)
    for i in range(SKETCH):
        least = np.minimum.reduceat((flat ^ _XOR32[i]) * _ODD32[i], starts)
        least ^= least >> np.uint32(15)
        out[:, i] = (least * np.uint32(0x2C1B3C6D)) >> np.uint32(24)
    return out


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for a set."""
    a = np.array([_mix(s + np.uint64(7)).sum(dtype=np.uint64) for s in sets], np.uint64)
    b = np.array([_mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64) for s in sets], np.uint64)
    return a.view(np.int64), b.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (digest of the set), bands (null for an empty set)."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for first, texts in text_chunks(batch):
                sets = shingle_sets(texts)
                a, b = _digests(sets)
                sizes = np.array([len(s) for s in sets])
                bands = half_bands(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, len(texts)), pa.array(sizes, pa.int64()),
                    pa.array(a), pa.array(b),
                    pa.array([x if n else None for x, n in zip(bands, sizes)], pa.list_(pa.int64())),
                ], names=["doc_id", "n_shingles", "d1", "d2", "bands"])
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>")


def _full_sets(docs: DataFrame) -> DataFrame:
    """d1, d2, the whole set and the sketch of each document."""
    def run(batches):
        for batch in batches:
            for _, texts in text_chunks(batch):
                sets = shingle_sets(texts)
                a, b = _digests(sets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                     pa.array([x.tobytes() for x in sketches(sets)], pa.binary())],
                    names=["d1", "d2", "shingles", "sketch"])
    return docs.select("text").mapInArrow(run, "d1 bigint, d2 bigint, shingles array<bigint>, sketch binary")


def _cells(nodes: DataFrame) -> DataFrame:
    """node, i (of its first half-band) and least (smallest node) of each table
    cell of two nodes or more.

    A half-band value that no other node has cannot be part of a shared
    cell, so keys are formed from the shared half-bands alone.
    """
    halves = nodes.select("node", F.posexplode("bands").alias("i", "value"))
    shared = halves.groupBy("i", "value").count().where("count > 1").drop("count")
    own = (halves.join(shared, ["i", "value"]).groupBy("node")
           .agg(F.collect_list(F.struct("i", "value")).alias("halves")))  # at most 2 * HALVES
    first = F.filter("halves", lambda h: h["i"] < HALVES)
    second = F.filter("halves", lambda h: h["i"] >= HALVES)
    keys = F.flatten(F.transform(first, lambda a: F.transform(second, lambda b: F.struct(
        a["i"].alias("i"), F.xxhash64(a["i"], a["value"], b["i"], b["value"]).alias("key")))))
    cells = stored(own.select("node", F.inline(keys)), "cells")
    full = cells.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    return cells.join(full.where("least <> most"), "key").select("node", "i", "least")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (u, v) whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    union = F.size("a") + F.size("b") - both
    return pairs.join(a, "u").join(b, "v").where(both * 100 >= union * PERCENT).select("u", "v")


def _forest(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Heaviest spanning forest by Prim: its edges (parent or -1 of each) and each one's tree."""
    n = len(rank)
    parent, tree = np.full(n, -1), np.full(n, -1)
    best, near = np.zeros(n, rank.dtype), np.full(n, -1)
    for _ in range(n):
        v = int(np.argmax(np.where(tree < 0, best, -1)))
        if best[v] > 0:
            parent[v] = near[v]
            tree[v] = tree[near[v]]
        else:
            v = int(np.argmax(tree < 0))
            tree[v] = v
        closer = (tree < 0) & (rank[v] > best)
        best[closer] = rank[v][closer]
        near[closer] = v
    return parent, tree


def _group_pairs(i: int, own: np.ndarray, node: np.ndarray, comp: np.ndarray, size: np.ndarray,
                 bands: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs to confirm among the members of a group of half-band i.

    A pair belongs to the group of the first half-band it shares, and there,
    if both are of one block (``own``), to that block's comparison with
    itself: it is handed on once. All sure pairs in sight join trees, in one order that
    all groups follow: a pair left out is connected by pairs further up.
    """
    a, b = np.triu_indices(len(node), 1)
    near = 100 * np.minimum(size[a], size[b]) >= PERCENT * np.maximum(size[a], size[b])
    near &= (comp[a] != comp[b])
    a, b = a[near], b[near]
    step = SKETCH // 8
    agree = np.zeros(len(a), np.int32)
    for k in range(0, SKETCH, step):  # the first parts leave out most
        for lo in range(0, len(a), 1 << 15):
            x, y = a[lo:lo + (1 << 15)], b[lo:lo + (1 << 15)]
            agree[lo:lo + (1 << 15)] += (sketch[x, k:k + step] == sketch[y, k:k + step]).sum(axis=1, dtype=np.int32)
        done = k + step
        share = DOUBTFUL / SKETCH
        keep = agree >= done * share - (0 if done == SKETCH else 4 * np.sqrt(done * share * (1 - share)))
        a, b, agree = a[keep], b[keep], agree[keep]
    if not len(a):
        return node[:0], node[:0]
    equal = bands[a, :HALVES] == bands[b, :HALVES]
    here = np.argmax(equal, axis=1) == i
    here &= (bands[a, HALVES:] == bands[b, HALVES:]).any(axis=1)
    if own.min() != own.max():
        here &= own[a] != own[b]
    sure = agree >= SURE
    rank = np.zeros((len(node), len(node)), np.int64)
    low, high = np.minimum(node[a], node[b]).astype(np.uint64), np.maximum(node[a], node[b]).astype(np.uint64)
    tie = (_mix(low * np.uint64(3) + _mix(high)) >> np.uint64(24)).astype(np.int64)
    order = (agree.astype(np.int64) << 40) | tie
    rank[a[sure], b[sure]] = rank[b[sure], a[sure]] = order[sure]
    same = comp[:, None] == comp[None, :]
    rank[same] = 1 << 60
    parent, tree = _forest(rank)
    in_forest = (parent[a] == b) | (parent[b] == a)
    out = here & np.where(sure, in_forest, tree[a] != tree[b])
    return node[a[out]], node[b[out]]


def _pairs_in_groups(members: DataFrame) -> DataFrame:
    """Pairs of nodes to confirm. ``members``: i, value, members, node, comp; then n_shingles, bands, sketch.

    A group with more than BLOCK members is dealt into blocks; each pair of
    blocks is looked at apart, so no task holds a whole group.
    """
    def run(batches):
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table):
            cell, i, own, node, comp, size = (table.column(c).to_numpy() for c in (
                "cell", "i", "own", "node", "comp", "n_shingles"))
            bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
            ends = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]])
            us, vs = [node[:0]], [node[:0]]
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                if b - a > 1:
                    u, v = _group_pairs(i[a], own[a:b], node[a:b], comp[a:b], size[a:b], bands[a:b], sketch[a:b])
                    us.append(u)
                    vs.append(v)
            u, v = np.concatenate(us), np.concatenate(vs)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))],
                                              names=["u", "v"])

        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            last = batch.column("cell")[len(batch) - 1].as_py()
            if held[0].column("cell")[0].as_py() == last:
                continue  # one cell so far
            table = pa.Table.from_batches(held)
            cut = int(np.flatnonzero(table.column("cell").to_numpy() != last)[-1]) + 1  # the last may go on
            yield flush(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield flush(pa.Table.from_batches(held))

    ordered = members.repartition("cell").sortWithinPartitions("cell")
    return ordered.select("cell", "i", "own", "node", "comp", "n_shingles", "bands", "sketch").mapInArrow(
        run, "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id reachable over links (similarity of
    the sets of 5-word shingles of 0.75 or more); kept marks the documents
    whose doc_id it is. A text of fewer than 5 words is one shingle; null or
    empty texts have no shingle, are linked with nothing and kept. Rows that
    share a doc_id are one document. A row without doc_id lends its links to
    others, but only rows with a doc_id name a component; it is always kept.
    An empty table gives no rows; columns other than doc_id and text are not
    read.
    """
    docs = docs.select("doc_id", "text")
    rows = stored(signatures(docs).withColumn("row", F.monotonically_increasing_id()), "signatures")
    some = rows.where("n_shingles > 0").drop("bands")
    kinds = stored(some.groupBy("d1", "d2").agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id")),
                   "sets")
    nodes = rows.join(kinds.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")

    # the groups of first half-bands, of nodes that share a cell
    cells = stored(_cells(nodes), "shared")
    value = F.element_at("bands", F.col("i") + 1)
    groups = stored(cells.select("node", "i").distinct().join(nodes.select("node", "bands"), "node")
                    .select("node", "i", value.alias("value")), "groups")
    members = groups.groupBy("i", "value").agg(F.count("*").alias("members")).where("members > 1")
    groups = groups.join(members, ["i", "value"])

    # their whole sets, from the texts
    wanted = nodes.join(cells.select("node").distinct(), "node", "left_semi").drop("bands")
    ids = wanted.select("doc_id").distinct()
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    sets = stored(_full_sets(texts).join(wanted.select("node", "d1", "d2", "n_shingles"), ["d1", "d2"])
                  .select("node", "n_shingles", "shingles", "sketch").dropDuplicates(["node"]), "shingles")

    # contract large groups
    large = groups.where(F.col("members") > block).select("node").distinct()
    stars = (cells.where("node <> least").join(large, "node", "left_semi")
             .select(F.col("least").alias("u"), F.col("node").alias("v")).distinct())
    linked = components(_confirmed(stars, sets).union(_same_document(some, kinds)))
    linked = stored(linked.select("node", F.col("root").alias("comp")), "linked")
    groups = groups.join(linked, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = groups.groupBy("i", "value").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b")
    groups = groups.join(mixed.select("i", "value"), ["i", "value"], "left_semi")

    blocks = F.ceil(F.col("members") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = (groups.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumn("cell", F.xxhash64("i", "value", F.least("own", "other"), F.greatest("own", "other")))
             .select("cell", "i", "own", "node", "comp")
             .join(sets.select("node", "n_shingles", "sketch"), "node").join(nodes.select("node", "bands"), "node"))
    late = _confirmed(_pairs_in_groups(dealt), sets)
    roots = stored(components(linked.select(F.col("node").alias("u"), F.col("comp").alias("v")).union(late)),
                   "roots")

    named = kinds.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "root").select("d1", "d2", "component_id")
    found = rows.drop("bands").join(named, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        (F.col("doc_id").isNull() | component.eqNullSafe(F.col("doc_id"))).alias("kept"))


def _same_document(some: DataFrame, kinds: DataFrame) -> DataFrame:
    """Links between the sets of rows that share a doc_id."""
    own = (some.where("doc_id IS NOT NULL").join(kinds.select("d1", "d2", "node"), ["d1", "d2"])
           .groupBy("doc_id").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most"))
    return (some.join(own, "doc_id").join(kinds.select("d1", "d2", "node"), ["d1", "d2"])
            .select(F.col("least").alias("u"), F.col("node").alias("v")).distinct())


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, all its columns as they were.

    It is the row with the smallest doc_id of the group (of rows that share
    this doc_id, the one with the smallest text). Rows without doc_id stay,
    and so do null and empty texts, which are near nothing. An empty table
    stays empty.
    """
    found = stored(near_duplicates(docs), "duplicates")
    # ids grow with the documents: never broadcast, whatever the estimate of a compressed file says
    stay = found.where("kept").select(F.col("doc_id").alias("__kept_id")).distinct().hint("merge")
    kept = docs.join(stay, docs["doc_id"].eqNullSafe(stay["__kept_id"]), "left_semi")
    twice = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(
        F.col("doc_id").alias("__kept_id"))
    if twice.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(twice["__kept_id"])
    first = (kept.join(twice, same, "left_semi").groupBy("doc_id")
             .agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.coalesce("text", F.lit(""))).alias("r")).select("r.*"))
    return kept.join(twice, same, "left_anti").unionByName(first)


