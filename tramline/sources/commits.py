"""Tables whose files are named by a log of commits (SNK-4, SNK-5, CHK-6).

``root/_commits`` has one small JSON file for each version, which lists the
files that the version adds to and removes from any number of tables. A
version comes into being by creating its file, which fails if there is one
already: so all tables change together or not at all, and of two writers of
one version one is told. Readers take their files from the log, never from
folders, hence see whole versions while files are being exchanged. Files
that a version removed stay until ``vacuum``.

Data files are plain Parquet under ``table/load=<id>/fetched_date=<day>/``,
so a day is pruned by its folder and many polls share a file.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass
from datetime import datetime, time, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tramline.sources.sinks import filesystem, put_if_absent

LOG = "_commits"
DATE = "fetched_date"
LOAD = "load"
ACTIONS = "version bigint, action string, table string, path string, day string, text string"
SNAPSHOT_EVERY = 50  # versions; then one file lists what is live, and readers start there


class Conflict(RuntimeError):
    """Another commit changed the same days since they were read."""


@dataclass(frozen=True)
class Files:
    """The data files of one load, and its schema, for one table."""
    table: str
    paths: list[str]
    schema: str


def _log_files(spark: SparkSession, root: str) -> dict[str, str]:
    """Names and paths in the log folder."""
    fs, p = filesystem(spark, os.path.join(root, LOG))
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(p)
            if re.fullmatch(r"\d{12}(\.live)?\.json", s.getPath().getName())}


def latest_version(spark: SparkSession, root: str) -> int:
    """The newest version, 0 before the first commit."""
    return max((int(n[:12]) for n in _log_files(spark, root)), default=0)


def actions(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The log up to a version: from the last list of live files on."""
    names = {n: p for n, p in _log_files(spark, root).items() if version is None or int(n[:12]) <= version}
    start = max((n for n in names if n.endswith(".live.json")), default="0" * 12 + ".live.json")
    paths = [p for n, p in names.items() if n == start or (n[:12] > start[:12] and not n.endswith(".live.json"))]
    if not paths:
        return spark.createDataFrame([], ACTIONS)
    return spark.read.schema(ACTIONS).json(paths)


def live_files(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """table, path, day of every file that a version has."""
    log = actions(spark, root, version)
    gone = log.where("action = 'remove'").select("table", "path")
    return log.where("action = 'add'").select("table", "path", "day").join(gone, ["table", "path"], "left_anti")


def _schema(spark: SparkSession, root: str, table: str, version: int | None) -> StructType | None:
    row = actions(spark, root, version).where((F.col("action") == "schema") & (F.col("table") == table)).orderBy(
        F.desc("version")).first()
    return StructType.fromJson(json.loads(row["text"])) if row else None


def read_table(spark: SparkSession, root: str, table: str, version: int | None = None,
               days=None, paths: list[str] | None = None, with_file: bool = False) -> DataFrame:
    """A table at a version (default: the newest), some of its days or files if so asked.

    The days wanted are looked up in the log, so files of others are not even
    opened; a filter on ``fetched_date`` prunes by folder as usual. A table
    that no commit has named raises ``KeyError``. ``with_file`` adds each
    row's file as ``__file``.
    """
    version = latest_version(spark, root) if version is None else version
    schema = _schema(spark, root, table, version)
    if schema is None:
        raise KeyError(f"{table} has no commit up to version {version}")
    if paths is None:
        files = live_files(spark, root, version).where(F.col("table") == table)
        if days is not None:
            files = files.where(F.col("day").isin([str(d) for d in days]))
        paths = [r["path"] for r in files.select("path").collect()]  # as many as the scan has files
    if not paths:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("__file", F.lit("")) if with_file else empty
    full = [os.path.join(root, table, p) for p in paths]
    rows = spark.read.option("basePath", os.path.join(root, table)).schema(schema).parquet(*full)
    return rows.select(*schema.names, *[F.col("_metadata.file_path").alias("__file")] * with_file)


def stage(df: DataFrame, root: str, table: str, sort_col: str | None = None) -> Files:
    """Write the rows as files that no version names yet.

    Rows are dealt by day with the sizes that adaptive execution aims at: a
    small day is one file, a large one is split, whatever number of polls
    they hold.
    """
    spark = df.sparkSession
    load = uuid.uuid4().hex
    folder = os.path.join(root, table, f"{LOAD}={load}")
    out = df.hint("rebalance", DATE)
    out = out.sortWithinPartitions(DATE, *[sort_col] if sort_col else [])
    out.write.partitionBy(DATE).parquet(folder)
    fs, p = filesystem(spark, folder)
    found, each = [], fs.listFiles(p, True)
    while each.hasNext():
        path = each.next().getPath().toString()
        if path.endswith(".parquet"):
            found.append(path[path.index(f"{LOAD}={load}"):])
    return Files(table, sorted(found), df.schema.json())


def day_of(path: str) -> str | None:
    """The day in a file's path (null: none)."""
    day = re.search(rf"/{DATE}=([^/]+)/", path)
    return None if day is None or day[1].startswith("__HIVE") else day[1]


def commit(spark: SparkSession, root: str, adds: list[Files], removes: dict[str, list[str]] | None = None,
           read_version: int | None = None, days: set | None = None) -> int:
    """Create the next version; returns it.

    Without ``read_version`` the commit only adds, and goes behind whatever
    came meanwhile. With it, it stands on what that version had in ``days``
    (all, if not given): if a later version touched any of them, ``Conflict``
    is raised and nothing changes.
    """
    lines = []
    for f in adds:
        lines.append({"action": "schema", "table": f.table, "text": f.schema})
        lines += [{"action": "add", "table": f.table, "path": p, "day": day_of(p)} for p in f.paths]
    for table, paths in (removes or {}).items():
        lines += [{"action": "remove", "table": table, "path": p, "day": day_of(p)} for p in paths]
    seen = latest_version(spark, root) if read_version is None else read_version
    while True:
        now = latest_version(spark, root)
        if read_version is not None and now > seen:
            later = actions(spark, root, now).where((F.col("version") > seen) & F.col("action").isin("add", "remove"))
            if days is not None:
                known = [str(d) for d in days if d is not None]
                later = later.where(F.col("day").isin(known) | (F.col("day").isNull() if None in days else F.lit(False)))
            if not later.isEmpty():
                raise Conflict(f"versions {seen + 1} to {now} changed the same days")
            seen = now
        version = now + 1
        text = "".join(json.dumps({"version": version, **x}) + "\n" for x in lines)
        if put_if_absent(spark, os.path.join(root, LOG, f"{version:012d}.json"), text):
            break
    if version % SNAPSHOT_EVERY == 0:
        _list_live(spark, root, version)
    return version


def _list_live(spark: SparkSession, root: str, version: int) -> None:
    """One file with all live files and the tables' schemas at a version."""
    log = actions(spark, root, version)
    newest = log.where("action = 'schema'").groupBy("table").agg(F.max_by("text", "version").alias("text"))
    rows = [{"version": version, "action": "schema", **r.asDict()} for r in newest.collect()]
    rows += [{"version": version, "action": "add", **r.asDict()} for r in live_files(spark, root, version).collect()]
    put_if_absent(spark, os.path.join(root, LOG, f"{version:012d}.live.json"), "".join(json.dumps(x) + "\n" for x in rows))


def rewrite(spark: SparkSession, root: str, tables: dict[str, tuple[DataFrame, list[str], str | None]],
            version: int, drop: dict[str, list[str]] | None = None) -> int:
    """Exchange files of several tables in one version.

    ``tables``: what takes the place of which files, and its sort column;
    ``drop``: files that go without a successor, unread.
    """
    adds, removes = [], {t: list(p) for t, p in (drop or {}).items()}
    for table, (df, paths, sort_col) in tables.items():
        adds.append(stage(df, root, table, sort_col))
        removes[table] = removes.get(table, []) + paths
    days = {day_of(p) for paths in removes.values() for p in paths}
    return commit(spark, root, adds, removes, version, days)


def vacuum(spark: SparkSession, root: str, keep_versions: int = 10, unused_for: timedelta = timedelta(days=1)) -> int:
    """Delete files that no version of the last ``keep_versions`` has; returns how many loads or files went.

    Folders of loads that no commit names (failed ones) go once they are older than ``unused_for``.
    """
    oldest = max(latest_version(spark, root) - keep_versions, 0)
    log = spark.read.schema(ACTIONS).json([p for n, p in _log_files(spark, root).items() if not n.endswith(".live.json")])
    gone = log.where((F.col("action") == "remove") & (F.col("version") <= oldest)).select("table", "path").collect()
    n = 0
    for r in gone:
        fs, p = filesystem(spark, os.path.join(root, r["table"], r["path"]))
        n += bool(fs.delete(p, False))
    named = {(r["table"], r["load"]) for r in log.where("action = 'add'").select(
        "table", F.substring_index("path", "/", 1).alias("load")).distinct().collect()}
    limit = (datetime.now(timezone.utc) - unused_for).timestamp() * 1000
    for table in {t for t, _ in named}:
        fs, p = filesystem(spark, os.path.join(root, table))
        for s in fs.listStatus(p):
            if (table, s.getPath().getName()) not in named and s.getModificationTime() < limit:
                n += bool(fs.delete(s.getPath(), True))
    return n


def purge(spark: SparkSession, root: str, families: list[tuple[str, str, tuple[str, ...]]], before: datetime,
          sort_cols: dict[str, str] | None = None, others: tuple[str, ...] = (), stamp: str = "fetched_at") -> int | None:
    """CHK-6: delete the parents stamped before a time and, with them, their children, in one version.

    ``families``: (parents, their key, tables that point to it). A child has
    its parent's day. Days that end before ``before`` go whole, by name. On
    its own day, parents older than it go and the children that point to
    them; only files with such rows are rewritten, others keep their names.
    ``others``: tables that go by their own stamp. Whatever fails, the version
    before stays; a commit in between on the same days raises ``Conflict``.
    Returns the new version, None if nothing goes.
    """
    version = latest_version(spark, root)
    day = before.date()
    names = [*others, *(t for parents, _, children in families for t in (parents, *children))]
    files = live_files(spark, root, version).where(F.col("table").isin(names) & (F.col("day") <= F.lit(str(day)))).collect()
    drop: dict[str, list[str]] = {}
    for r in files:  # as many as files
        if r["day"] < str(day):
            drop.setdefault(r["table"], []).append(r["path"])
    tables: dict[str, tuple[DataFrame, list[str], str | None]] = {}
    if before.time() > time.min:
        present = {r["table"] for r in files if r["day"] == str(day)}
        old = F.coalesce(F.col(stamp) < F.lit(before), F.lit(False))

        def rows(table: str, paths: list[str] | None = None) -> DataFrame:
            return read_table(spark, root, table, version, [day], paths, with_file=paths is None)

        def cut(table: str, going, staying) -> None:
            paths = touched(going(rows(table)), table) if table in present else []
            if paths:
                tables[table] = (staying(rows(table, paths)), paths, (sort_cols or {}).get(table))
        for parents, key, children in families:
            gone = rows(parents).where(old).select(key).distinct() if parents in present else None
            for child in children if gone is not None else ():
                cut(child, lambda df, g=gone, k=key: df.join(g, k, "left_semi"), lambda df, g=gone, k=key: df.join(g, k, "left_anti"))
        for table in (*others, *(parents for parents, _, _ in families)):
            cut(table, lambda df: df.where(old), lambda df: df.where(~old))
    if not drop and not tables:
        return None
    return rewrite(spark, root, tables, version, drop)


def touched(rows: DataFrame, table: str) -> list[str]:
    """The files, as the log names them, that rows read ``with_file`` come from."""
    found = rows.select("__file").distinct().collect()  # as many as files
    return sorted(unquote(r["__file"]).split(f"/{table}/", 1)[1] for r in found)
