"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import stored

MAX_ROUNDS = 60


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (two long columns u, v); root: its smallest node.

    Each round hangs every node's larger neighbours, then its smaller ones,
    on its smallest neighbour; the number of rounds grows with the logarithm
    of the longest path. Minima are combined before the shuffle and the joins
    can be split, so a node with very many neighbours is no bottleneck. Each
    round is written to the shared folder.
    """
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u <> v").distinct(), "edges")
    before = _state(edges)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        hung = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(hung.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
