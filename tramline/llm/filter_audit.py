"""How filters interact, from sorted posting lists of the documents that fail them.

Every document gets a row number; ranges of numbers are read apart. For each
part and range there is one sorted list of numbers for each filter (the
documents that fail it) and one for each label. Unions of filters and what a
filter adds to a union are counted by merging the lists: the list with the
least head is galloped through up to the next head of the others, so runs
that one list has alone cost a logarithm. The sizes add up over the ranges,
and every order of the filters is read off them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tramline.llm.common import bounded_batches, stored, text_chunks

# The filters of the query: names in the order of the bits of ``fails``.
NAMES = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 3
MARKS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

RANGE = 1 << 15  # documents of a range: its lists are small, however large a part is


def gallop(ids: list[int], key: int, at: int) -> int:
    """First place from ``at`` on with an id of ``key`` or more, by doubling steps and then halving."""
    step, n = 1, len(ids)
    if at >= n or ids[at] >= key:
        return at
    while at + step < n and ids[at + step] < key:
        at += step
        step *= 2
    return bisect_left(ids, key, at + 1, min(at + step, n))


def union(lists: list[list[int]]) -> list[int]:
    """The ids of any of the sorted lists, each once."""
    live = [[ids[0], 0, ids] for ids in lists if ids]
    out: list[int] = []
    while len(live) > 1:
        low = min(live, key=lambda x: x[0])
        head = min(x[0] for x in live if x is not low)
        if low[0] == head:
            end = low[1] + 1  # another list has it too
        else:
            end = gallop(low[2], head, low[1])
            out += low[2][low[1]:end]
        low[1] = end
        if end == len(low[2]):
            live = [x for x in live if x is not low]
        else:
            low[0] = low[2][end]
    for _, at, ids in live:
        out += ids[at:]
    return out


def difference(ids: list[int], other: list[int]) -> list[int]:
    """The ids of the first list that the second has not."""
    out: list[int] = []
    at = seen = 0
    while at < len(ids):
        seen = gallop(other, ids[at], seen)
        if seen == len(other):
            return out + ids[at:]
        end = gallop(ids, other[seen], at)
        out += ids[at:end]
        at = end + (end < len(ids) and ids[end] == other[seen])
    return out


def set_sizes(postings: list[list[int]], labels: list[list[int]]) -> list[tuple[int, int, list[int]]]:
    """(filters as bits, size of their union, how many of the union have each label), for every set of filters."""
    out = []
    for bits in range(1 << len(postings)):
        failing = union([ids for k, ids in enumerate(postings) if bits >> k & 1])
        out.append((bits, len(failing), [len(ids) - len(difference(ids, failing)) for ids in labels]))
    return out


def text_failures(texts: list[bytes]) -> dict[str, list]:
    """The bits of the filters on single texts (A to D), and each text's digest for E."""
    bits, digests = [], []
    for t in texts:
        words = t.split()  # of bytes: at \x20 and \x09 to \x0D
        points = len(t) if t.isascii() else len(t.decode("utf-8", "replace"))
        capitals = len(t) - len(t.translate(None, CAPITALS))
        bits.append((len(words) < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
                    | (100 * capitals > MAX_CAPITAL_PERCENT * points) << 2
                    | (len(t.translate(None, MARKS)) < len(t)) << 3)
        digests.append(hashlib.sha256(t).digest())
    return {"fails": bits, "digest": digests}


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each document: part, fails (bits of A to E), good, toxic.

    E: some row with a smaller doc_id has this text. Rows with one doc_id do
    not fail each other by that, and a null id is larger than any other.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch):
                found, part = text_failures(texts), batch.slice(first, len(texts))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), "part": part.column("part"),
                     "fails": pa.array(found["fails"], pa.int32()), "digest": pa.array(found["digest"], pa.binary())})
    kind = dict(docs.dtypes)["doc_id"]
    rows = stored(docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")
                  .mapInArrow(run, f"doc_id {kind}, part string, fails int, digest binary"), "failures")
    repeated = (rows.groupBy("digest").agg(F.min("doc_id").alias("__least"), F.count("*").alias("__n"))
                .where("__n > 1").select("digest", "__least"))
    marked = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                          F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    copy = F.col("__least").isNotNull() & (F.col("doc_id").isNull() | (F.col("__least") < F.col("doc_id")))
    return (rows.join(repeated, "digest", "left").join(marked.where("doc_id IS NOT NULL"), "doc_id", "left")
            .select("part", F.when(copy, F.col("fails").bitwiseOR(F.lit(16))).otherwise(F.col("fails")).alias("fails"),
                    (F.coalesce("good", F.lit(0)) == 1).alias("good"), (F.coalesce("toxic", F.lit(0)) == 1).alias("toxic")))


def postings(failing: DataFrame, n_filters: int = len(NAMES), labels: tuple[str, ...] = ("good", "toxic")) -> DataFrame:
    """One row for each part and range of row numbers: n, and a sorted list of numbers for each filter and label."""
    rows = stored(failing.withColumn("__id", F.monotonically_increasing_id()), "numbered")
    mine = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("__id"))))
    lists = [mine(F.col("fails").bitwiseAND(F.lit(1 << k)) != 0).alias(f"f{k}") for k in range(n_filters)]
    return (rows.groupBy("part", F.floor(F.col("__id") / RANGE).alias("id_range"))
            .agg(F.count("*").alias("n"), *lists, *(mine(F.col(x)).alias(x) for x in labels)))


def union_sizes(lists: DataFrame, n_filters: int = len(NAMES), labels: tuple[str, ...] = ("good", "toxic")) -> DataFrame:
    """For each part and set of filters (``bits``): n documents of the part, size of the union, of it with each label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = set_sizes([row[f"f{k}"] for k in range(n_filters)], [row[x] for x in labels])
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([row["part"]] * len(found)), "n": pa.array([row["n"]] * len(found), pa.int64()),
                     "bits": pa.array([b for b, _, _ in found], pa.int32()),
                     "failing": pa.array([s for _, s, _ in found], pa.int64())}
                    | {x: pa.array([s[k] for _, _, s in found], pa.int64()) for k, x in enumerate(labels)})
    sized = lists.mapInArrow(run, "part string, n bigint, bits int, failing bigint"
                                  + "".join(f", {x} bigint" for x in labels))
    return sized.groupBy("part", "bits").agg(*(F.sum(x).alias(x) for x in ("n", "failing", *labels)))


def steps(names: str = NAMES) -> list[tuple[str, int, int, int, int, int]]:
    """(order, step, its filter, bits of the earlier filters, bits of the filter, bits of all the others)."""
    full = (1 << len(names)) - 1
    out = []
    for order in permutations(range(len(names))):
        before = 0
        for step, k in enumerate(order, 1):
            out.append(("".join(names[i] for i in order), step, k, before, 1 << k, full ^ 1 << k))
            before |= 1 << k
    return out


def interactions(sizes: DataFrame, names: str = NAMES) -> DataFrame:
    """One row for each part, order of the filters and step, from ``union_sizes``.

    What a filter removes after others is what it adds to their union.
    ``shapley`` is that, summed over all orders.
    """
    table = sizes.sparkSession.createDataFrame(
        steps(names), "filter_order string, step int, k int, before int, own int, others int")
    by_part = sizes.groupBy("part").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(
        F.struct("bits", "failing", "good", "toxic"))).alias("u"))  # as many entries as sets of filters
    u = lambda bits, field: F.element_at("u", bits + 1)[field]
    after = F.col("before") + F.col("own")
    added = lambda field: u(after, field) - u(F.col("before"), field)
    every = Window.partitionBy("part", "k")
    return (by_part.withColumn("bits", F.explode(F.col("u.bits"))).join(table, F.col("bits") == F.col("before"))
            .withColumn("removed", added("failing"))
            .select("part", "filter_order", "step", (F.col("n") - u(after, "failing")).alias("kept"), "removed",
                    (u(F.col("own"), "failing") - F.col("removed")).alias("redundant"),
                    (u(F.col("own") + F.col("others"), "failing") - u(F.col("others"), "failing")).alias("unique_fails"),
                    added("good").alias("good_lost"), added("toxic").alias("toxic_lost"),
                    F.sum("removed").over(every).alias("shapley")))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters of the query over ``docs`` (doc_id, text, lang) in all 120 orders, by part.

    One row for each part, order and step, zeros included. A null text is
    empty, a null lang the part with the empty name. Each row of ``docs`` is
    a document, whatever its id; a document has a label if any row of
    ``labels`` gives it to its id, a null id has none. An empty table gives
    no rows; columns other than those named are not read.
    """
    return interactions(union_sizes(postings(failures(docs, labels))))
