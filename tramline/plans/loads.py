"""End-to-end loads: the static warehouse (SNK-1) and the dimension seed (SNK-3).

Both read a staged feed folder, write a new version, run their checks as
Spark jobs on it and make it current only if they pass, so a failed run
leaves the previous tables in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators import dims as D
from tramline.operators import quality as Q
from tramline.sources import gtfs as G
from tramline.sources.schemas import (
    DIM_PRIMARY_KEYS, GTFS_FOREIGN_KEYS, GTFS_LOAD_ORDER, GTFS_NOT_NULL, GTFS_PRIMARY_KEYS,
    WAREHOUSE_NOT_NULL,
)
from tramline.sources.sinks import path_exists, publish_tables

DIMENSION_FILES = ("stops", "routes", "trips")


def key_checks(tables: dict[str, DataFrame], not_null: dict, primary_keys: dict) -> list[str]:
    """CHK-1/CHK-2 over written tables -> problems found.

    One aggregate per table for NOT NULL, one grouped count per primary key.
    """
    problems = []
    for name, df in tables.items():
        nn = Q.not_null_violations(df, not_null[name]).filter(F.col("null_count") > 0)
        for r in nn.collect():  # at most one row per checked column
            problems.append(f"{name}.{r.column_name}: {r.null_count} NULL")
        if not Q.pk_violations(df, primary_keys[name]).isEmpty():
            problems.append(f"{name}: duplicate primary key {primary_keys[name]}")
    return problems


def feed_checks(tables: dict[str, DataFrame], enforce_fk: bool = False) -> list[str]:
    """CHK-1/CHK-2 (and CHK-3 when asked) over a feed's tables -> problems found.

    The reference declares foreign keys but SQLite does not enforce them,
    so FK breaks are reported only with ``enforce_fk``.
    """
    problems = key_checks(tables, GTFS_NOT_NULL, GTFS_PRIMARY_KEYS)
    if enforce_fk:
        checks = [(c, tables[c], cc, p, tables[p], pc) for c, cc, p, pc in GTFS_FOREIGN_KEYS
                  if c in tables and p in tables]
        if checks:
            for r in Q.fk_report(checks).filter(F.col("violations") > 0).collect():
                problems.append(f"{r.child_table}.{r.child_column} -> {r.parent_table}: "
                                f"{r.violations} orphans")
    return problems


def load_static_feed(spark: SparkSession, feed_dir: str, out_root: str, strict: bool = True,
                     enforce_fk: bool = False) -> dict[str, str]:
    """Static load: read, type and check the feed, then replace all tables.

    Tables are published parents first. A missing file fails before anything
    is written; key / NOT NULL problems abort the publish. Bad text in a typed
    column fails (``strict``), or else becomes NULL and is published with its
    row as ``bad_values`` beside the tables; a row that cannot do without the
    value is there only.
    """
    if strict:
        tables = G.read_feed(spark, feed_dir, GTFS_LOAD_ORDER)
    else:
        tables, report = G.read_feed_with_report(spark, feed_dir, GTFS_LOAD_ORDER)
        tables["bad_values"] = report

    def checks(staged: dict[str, DataFrame]) -> list[str]:
        return feed_checks({t: df for t, df in staged.items() if t != "bad_values"}, enforce_fk)
    return publish_tables(spark, tables, out_root, order=list(tables), checks=checks)


def load_dimensions(spark: SparkSession, feed_dir: str, out_root: str
                    ) -> tuple[dict[str, str], DataFrame]:
    """Dimension seed: dim_stations, dim_routes, dim_trips (orphan trips dropped).

    All three become current together, after their keys and NOT NULL columns
    are checked as the warehouse's constraints do; returns the published
    paths and a one-row (kept, rejected) trip count.
    """
    missing = [f for f in DIMENSION_FILES if not path_exists(spark, f"{feed_dir}/{f}.txt")]
    if missing:
        raise G.MissingFeedFile(f"missing GTFS files: {', '.join(m + '.txt' for m in missing)}")
    stations = D.dim_stations(G.read_feed_text(spark, feed_dir, "stops"))
    routes = D.dim_routes(G.read_feed_text(spark, feed_dir, "routes"))
    raw_trips = G.read_feed_text(spark, feed_dir, "trips")
    trips, _ = D.dim_trips(raw_trips, routes)
    paths = publish_tables(spark, {"dim_stations": stations, "dim_routes": routes,
                                   "dim_trips": trips}, out_root,
                           order=["dim_stations", "dim_routes", "dim_trips"],
                           checks=lambda t: key_checks(t, WAREHOUSE_NOT_NULL, DIM_PRIMARY_KEYS))
    counts = D.dim_trips_counts(raw_trips, spark.read.parquet(paths["dim_routes"]))
    return paths, counts
