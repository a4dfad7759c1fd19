"""Uniform shuffle into shards of exact sizes by a hypergeometric matrix.

How many rows of each source partition go to each shard is drawn first: a
uniform shuffle deals a partition's rows like balls drawn without putting
back, so the counts follow the multivariate hypergeometric law, and drawing
them fixes both the partitions' and the shards' sizes exactly. Rows are put
in random order within the partition that reads them, the places cut by the
drawn counts, the rows exchanged, and ranked at random again within their
shard. All row work is DataFrame operations; the driver draws the matrix,
one row for each partition, and hands it on as a file.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import group_rank, n_buckets, scratch_path, stored
from tramline.sources.sinks import filesystem

LARGE = 900_000_000  # numpy draws from urns of up to 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` balls are good; exact for urns of any size."""
    if good + bad <= LARGE:
        return int(rng.hypergeometric(good, bad, drawn)) if drawn else 0
    low, high = max(0, drawn - bad), min(good, drawn)
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))
    spread = int(12 * math.sqrt(drawn * good * bad) / (good + bad)) + 50
    a, b = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(a, b, dtype=np.float64)  # weight ratio of k + 1 to k
    ratio = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    log_weight = np.concatenate([[0.0], np.cumsum(ratio)])
    weight = np.cumsum(np.exp(log_weight - log_weight.max()))
    return a + int(np.searchsorted(weight, rng.random() * weight[-1], side="right"))


def draw_matrix(partition_rows: list[int], shard_rows: list[int], seed: int) -> list[list[int]]:
    """Rows from each partition (row) to each shard (column), with these sums."""
    rng = np.random.default_rng(seed)
    left = list(shard_rows)
    matrix = []
    for n in partition_rows:
        total, row = sum(left), []
        for free in left:
            take = hypergeometric(rng, free, total - free, n)
            row.append(take)
            total -= free
            n -= take
        left = [a - b for a, b in zip(left, row)]
        matrix.append(row)
    return matrix


def shard_sizes(rows: int, n_shards: int) -> list[int]:
    return [rows // n_shards + (s < rows % n_shards) for s in range(n_shards)]


def shuffle_into_shards(docs: DataFrame, n_shards: int, seed: int = 7) -> DataFrame:
    """``docs`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in its shard).

    Shard sizes differ by one row at most. Rows are told apart by place, not
    by content: repeated rows and null ids are dealt out like any others. An
    empty table gives no rows. A column of ``docs`` named shard or slot gives
    way to the one added here; other names do not matter.
    """
    spark = docs.sparkSession
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own"),
                      F.monotonically_increasing_id().alias("__id"))
    # the id after the sort holds the partition (its upper 31 bits) and the place in it
    rows = stored(own.sortWithinPartitions(F.xxhash64("__id", F.lit(seed + 1)), "__id")
                  .select("own", F.monotonically_increasing_id().alias("__row")), "rows")
    part = F.shiftrightunsigned("__row", 33)
    counts = {r["part"]: r["count"] for r in rows.groupBy(part.alias("part")).count().collect()}  # a number a partition
    parts, total = sorted(counts), sum(counts.values())
    matrix = draw_matrix([counts[p] for p in parts], shard_sizes(total, n_shards), seed)
    drawn = _shipped(spark, [{"__part": p, "__ends": np.cumsum(row).tolist()} for p, row in zip(parts, matrix)])
    dealt = (rows.withColumn("__part", part).withColumn("__rank", F.col("__row").bitwiseAND(F.lit((1 << 33) - 1)))
             .join(drawn, "__part")
             .withColumn("shard", F.size(F.filter("__ends", lambda e: e <= F.col("__rank")))))
    again = F.xxhash64("__row", F.lit(seed + 2))
    buckets = n_buckets(spark, math.ceil(total / n_shards))
    placed = group_rank(dealt, ["shard"], [again, F.col("__row")],
                        F.pmod(F.xxhash64("__row", F.lit(seed + 3)), F.lit(buckets)), "slot")
    return placed.select(*(F.col("own")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")), "shard", "slot")


def _shipped(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """The matrix as a JSON file in the shared folder, so that no plan holds it."""
    path = scratch_path(spark, "matrix") + ".json"
    fs, p = filesystem(spark, path)
    out = fs.create(p, True)
    for r in rows:
        out.write(bytearray((json.dumps(r) + "\n").encode()))
    out.close()
    return spark.read.schema("__part bigint, __ends array<bigint>").json(path)


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder for each shard, its files and their rows in the order of ``slot``.

    Nulls and repeated rows are written as they are; an empty table writes no
    folder of a shard.
    """
    run = F.floor(F.col("slot") / rows_per_file)
    (sharded.repartition("shard", run).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def shard_table(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text).cast("long") + 8).alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
    return shuffle_into_shards(sized, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
