"""Writers (SNK-1..SNK-5).

Parquet has no multi-table commit, so a multi-table load is versioned: every
table is written once, under the folder of a new version, the checks run on
what was written, and then one small file in the manifest, created only if
it is not there, makes the version current. Readers take their paths from
the manifest, so they see all tables of one version or all of another,
wherever a load fails. Tables that grow poll by poll are in ``commits``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CheckFailed(RuntimeError):
    pass


def append_rows(df: DataFrame, path: str) -> None:
    """SNK-2: append one typed row set (an empty input adds no rows)."""
    df.write.mode("append").parquet(path)


_MANIFEST = "_manifest"


def filesystem(spark: SparkSession, path: str):
    """The store that holds a path, and the path in its terms."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in any store that Spark can read."""
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with a text; False, with nothing changed, if there is one of that name.

    The text is written under another name first, so no reader sees half of it.
    """
    fs, p = filesystem(spark, path)
    fs.mkdirs(p.getParent())
    draft = f".{uuid.uuid4().hex}"
    if fs.getUri().getScheme() == "file":
        target = p.toUri().getPath()
        source = os.path.join(os.path.dirname(target), draft)
        with open(source, "w") as f:
            f.write(text)
        try:
            os.link(source, target)  # fails if the name is taken
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(source)
    hadoop = spark._jvm.org.apache.hadoop.fs
    source = hadoop.Path(p.getParent(), draft)
    out = fs.create(source, False)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").NONE
    try:
        hadoop.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(source, p, options)
        return True
    except Exception as e:
        fs.delete(source, False)
        if "AlreadyExists" in str(e):
            return False
        raise


def versions(spark: SparkSession, root: str) -> list[str]:
    """The complete versions that are still there, oldest first."""
    fs, p = filesystem(spark, os.path.join(root, _MANIFEST))
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.isdigit())


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that the last complete load made current."""
    return max(versions(spark, root), default=None)


def _folder(spark: SparkSession, root: str, version: str) -> str:
    """The folder that a version's line in the manifest names."""
    return spark.read.text(os.path.join(root, _MANIFEST, version)).first()[0]


def published_path(spark: SparkSession, root: str, name: str) -> str:
    return os.path.join(root, _folder(spark, root, current_version(spark, root)), name)


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(published_path(spark, root, name))


class LoadConflict(RuntimeError):
    """Another load made its version current while this one ran."""


def publish_tables(spark: SparkSession, tables: dict[str, DataFrame], root: str,
                   order=None, checks=None, keep: int = 3) -> dict[str, str]:
    """SNK-1 / SNK-3: write all tables of a new version, validate, then switch to it.

    ``checks(written: dict[name, DataFrame])`` returns a list of problems. A
    problem or a failure at any point leaves the old version current; the
    unfinished folder is removed. Of two loads at once the first to finish
    wins and the other raises ``LoadConflict``. The last ``keep`` versions
    stay for readers that hold their paths. Returns {name: published path}.
    """
    names = list(order or tables)
    before = current_version(spark, root)
    version = f"{int(before or 0) + 1:010d}"
    relative = f"version={version}-{uuid.uuid4().hex[:8]}"
    folder = os.path.join(root, relative)
    paths = {n: os.path.join(folder, n) for n in names}
    try:
        for n in names:
            tables[n].write.parquet(paths[n])
        problems = checks({n: spark.read.parquet(p) for n, p in paths.items()}) if checks else []
        if problems:
            raise CheckFailed("; ".join(problems))
        if not put_if_absent(spark, os.path.join(root, _MANIFEST, version), relative):
            raise LoadConflict(f"version {version} is another load's")
    except Exception:
        fs, p = filesystem(spark, folder)
        fs.delete(p, True)
        raise
    for old in versions(spark, root)[:-keep]:
        for path in (os.path.join(root, _folder(spark, root, old)), os.path.join(root, _MANIFEST, old)):
            fs, p = filesystem(spark, path)
            fs.delete(p, True)
    return paths


def write_fact_layout(df: DataFrame, path: str, ts_col: str = "fetched_at",
                      sort_col: str = "trip_id", mode: str = "overwrite",
                      num_partitions: int | None = None) -> None:
    """SNK-5: partition by poll date, files range-sorted by ``sort_col``.

    ``repartitionByRange(date, key, row hash)`` spreads one day over many
    tasks and leaves each file sorted by the key, so Parquet min/max
    statistics let readers skip files for a trip or stop filter. The row-hash
    tiebreak lets range bounds fall *inside* one key, so a trip holding a
    third of a day's rows is still written by many tasks. Without
    ``num_partitions`` AQE sizes the range partitions from the data.
    """
    out = (df.withColumn("fetched_date", F.to_date(ts_col))
             .withColumn("_tiebreak", F.xxhash64(*[F.col(c) for c in df.columns])))
    keys = ["fetched_date", sort_col, "_tiebreak"]
    ranged = (out.repartitionByRange(num_partitions, *keys) if num_partitions
              else out.repartitionByRange(*keys))
    (ranged
        .sortWithinPartitions("fetched_date", sort_col)
        .drop("_tiebreak")
        .write.mode(mode).partitionBy("fetched_date").parquet(path))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None
                   ) -> None:
    """SNK-5: bucket parent and child tables on the surrogate key.

    Two tables bucketed the same way on ``update_pk`` join without a shuffle.
    """
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
