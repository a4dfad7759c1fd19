"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tramline.session import ensure_checkpoint_dir

# Texts are taken into numpy this many bytes at a time; one longer text is
# taken alone.
CHUNK_BYTES = 2 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the cluster."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    outlives lost executors, and makes a non-deterministic column fixed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, records: int = 512) -> None:
    """Fewer rows in one Arrow batch: texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))


def text_chunks(batch: pa.RecordBatch, column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8 bytes, null as empty) of at most ``limit`` bytes."""
    texts = batch.column(column).cast(pa.large_binary()).to_pylist()
    first, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > first and size + n > limit:
            yield first, [x or b"" for x in texts[first:i]]
            first, size = i, 0
        size += n
    if texts:
        yield first, [x or b"" for x in texts[first:]]


def per_text(fn: Callable[[list[bytes]], dict[str, list]], columns: dict[str, pa.DataType],
             keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function: ``fn`` turns texts into lists of values, one for each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch):
                out = fn(texts)
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keys]
                    + [pa.array(out[c], t) for c, t in columns.items()],
                    names=[*keys, *columns])
    return run


def n_buckets(spark: SparkSession, rows: int, per_bucket: int = 200_000) -> int:
    """How many buckets keep each near ``per_bucket`` rows, and all cores busy."""
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, math.ceil(rows / per_bucket), 1)


def group_rank(df: DataFrame, keys: list[str], order: list[Column], bucket: Column,
               rank: str) -> DataFrame:
    """Gapless rank from 0 within each key, without a task that holds a whole key.

    ``bucket`` splits a key into ordered parts: rows of a lower bucket come
    first, rows of one bucket by ``order``. The counts of the buckets give
    each bucket its first rank, and only one bucket is sorted at a time.
    ``df`` must give the same rows each time it is read (see ``stored``).
    """
    part = f"__{rank}_bucket"
    base = f"__{rank}_first"
    df = df.withColumn(part, bucket)
    counts = df.groupBy(*keys, part).count()
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(*keys, part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(base))
    inside = Window.partitionBy(*keys, part).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(inside).cast("long") - 1)
    return (ranked.join(firsts, [*keys, part])
            .withColumn(rank, F.col(rank) + F.col(base)).drop(part, base))
