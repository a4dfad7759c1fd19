"""Quality by importance resampling with hashed n-gram models.

Words and pairs of words are hashed into ``BUCKETS`` buckets. Two bag models
are counted over them: the target (documents labelled good and not toxic) and
the raw corpus. A document's weight is the sum of the log ratios of its
buckets; resampling without replacement by these weights is a Gumbel top-k:
a hash of the document gives its Gumbel noise, and the k documents with the
largest sum of weight and noise are drawn.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import bounded_batches, stored, text_chunks

BUCKETS = 65_536
PRIOR = 3.0                 # pseudo-counts that pull a ratio to 1 where there is little evidence
MAX_TARGET_DOCS = 50_000    # labelled documents that the target model learns from
SPLITTERS = 256  # parts that each step of the search for the k-th key cuts


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words, then the pairs of words, of each text; how many each text has."""
    split = [t.lower().split() for t in texts]
    words = [w for s in split for w in s]
    seen = {w: xxhash.xxh3_64_intdigest(w) for w in dict.fromkeys(words)}
    hashes = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    sizes = np.array([len(s) for s in split], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
    pairs = (pairs ^ (pairs >> np.uint64(29)))[doc[:-1] == doc[1:]]
    every = np.concatenate([hashes, pairs])
    owner = np.concatenate([doc, doc[:-1][doc[:-1] == doc[1:]]])
    order = np.argsort(owner, kind="stable")
    return (every[order] % np.uint64(BUCKETS)).astype(np.int64), np.bincount(owner, minlength=len(texts))


def _models(docs: DataFrame, target: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket counts of the target documents and of all: 2 * BUCKETS numbers, whatever the corpus."""
    wanted = np.array(sorted(target), np.int64)

    def run(batches):
        raw, own = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            ids = np.array([-1 if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)
            known = np.array([x is not None for x in batch.column("doc_id").to_pylist()])
            chosen = np.isin(ids, wanted) & known
            for first, texts in text_chunks(batch):
                buckets, sizes = _features(texts)
                raw += np.bincount(buckets, minlength=BUCKETS)
                mine = np.repeat(chosen[first:first + len(texts)], sizes)
                own += np.bincount(buckets[mine], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(raw[some]), pa.array(own[some])],
                                         names=["bucket", "n_raw", "n_target"])
    counted = (docs.select("doc_id", "text").mapInArrow(run, "bucket bigint, n_raw bigint, n_target bigint")
               .groupBy("bucket").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target")))
    raw, own = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counted.collect():  # at most BUCKETS rows
        raw[r["bucket"]], own[r["bucket"]] = r["n_raw"], r["n_target"]
    return own, raw


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the two models for each bucket, 0 where nothing is known."""
    expected = raw * (target.sum() / max(raw.sum(), 1.0))
    return np.log((target + PRIOR) / (expected + PRIOR))


def importance_resample(docs: DataFrame, labels: DataFrame, share: float | None = None,
                        length_power: float = 0.5) -> DataFrame:
    """doc_id, n_features, log_ratio, log_weight, gumbel_key, kept of each row of ``docs``.

    ``kept`` marks the k rows with the largest gumbel_key, k being ``share``
    of all rows; without it, the share of good and not toxic documents among
    the labelled ones. The target model learns from at most 50,000 such
    documents, those of the smallest hash of doc_id. log_ratio is the log
    ratio of the two models; log_weight, which draws, is that divided by the
    number of features to the ``length_power`` (0: the ratio itself), so that
    a long text's length alone does not decide. A text without words, null or not, has weight 0.
    Without labels all weights are 0 and all rows are kept. A doc_id that is
    null or not labelled counts for the raw model; labels with nulls are
    left out; rows repeated with the same text get the same noise. Columns
    other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    total, n_good = known.agg(F.count("*"), F.coalesce(F.sum(good.cast("long")), F.lit(0))).first()
    if share is None:
        share = n_good / total if total else 1.0
    target = [r[0] for r in known.where(good).select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TARGET_DOCS).collect()]
    ratios = spark.sparkContext.broadcast(log_ratios(*_models(docs, target)))  # BUCKETS numbers

    def weigh(batches):
        for batch in batches:
            for first, texts in text_chunks(batch):
                part = batch.slice(first, len(texts))
                buckets, sizes = _features(texts)
                owner = np.repeat(np.arange(len(texts)), sizes)
                weight = np.bincount(owner, weights=ratios.value[buckets], minlength=len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("noise"), pa.array(sizes, pa.int64()),
                     pa.array(weight, pa.float64()),
                     pa.array(weight / np.maximum(sizes, 1) ** length_power, pa.float64())],
                    names=["doc_id", "noise", "n_features", "log_ratio", "log_weight"])
    kind = dict(docs.dtypes)["doc_id"]
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(11)), 11).cast("double") + 0.5) / 2.0**53
    scored = (docs.select("doc_id", "text", (-F.log(-F.log(uniform))).alias("noise"))
              .mapInArrow(weigh, f"doc_id {kind}, noise double, n_features bigint, log_ratio double, log_weight double")
              .select("doc_id", "n_features", "log_ratio", "log_weight", (F.col("log_weight") + F.col("noise")).alias("gumbel_key"),
                      F.monotonically_increasing_id().alias("__row")))
    rows = stored(scored, "weights")
    n = rows.count()
    k = round(share * n)
    if not 0 < k < n:
        chosen = F.lit(k > 0)
    else:  # the key and the row of the k-th are all that is needed: no rank of every row
        key, before = nth_value(rows, "gumbel_key", k, descending=True)
        row, _ = nth_value(rows.where(F.col("gumbel_key") == F.lit(key)), "__row", k - before)
        chosen = (F.col("gumbel_key") > F.lit(key)) | ((F.col("gumbel_key") == F.lit(key)) & (F.col("__row") <= F.lit(row)))
    return rows.select("doc_id", "n_features", "log_ratio", "log_weight", "gumbel_key", chosen.alias("kept"))


def nth_value(df: DataFrame, column: str, n: int, descending: bool = False) -> tuple[float | int, int]:
    """The n-th value (from 1) of a column in order, and how many values come before it.

    The interval that holds it is cut at quantiles, the rows between and on
    the cuts are counted, and the search goes on in one part of them; what
    comes to the driver are the cuts and their counts, ``SPLITTERS`` at most.
    """
    x, inside, before = F.col(column), df, 0
    while True:
        at = [i / SPLITTERS for i in range(SPLITTERS + 1)]
        cuts = sorted(set(inside.select(F.percentile_approx(column, at, 10_000)).first()[0]))
        listed = F.array(*map(F.lit, cuts))
        # an even part is an open interval, an odd one a cut itself
        part = (2 * F.size(F.filter(listed, lambda c: c < x)) + F.array_contains(listed, x).cast("int")).alias("part")
        counts = {r["part"]: r["count"] for r in inside.groupBy(part).count().collect()}
        for p in sorted(counts, reverse=descending):
            if before + counts[p] >= n:
                break
            before += counts[p]
        if p % 2:
            return cuts[p // 2], before
        low, high = cuts[p // 2 - 1] if p else None, cuts[p // 2] if p // 2 < len(cuts) else None
        inside = inside.where((x > F.lit(low) if low is not None else F.lit(True))
                              & (x < F.lit(high) if high is not None else F.lit(True)))
