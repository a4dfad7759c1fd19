"""Poll files as a stream (STR-1, STR-2, STR-3, SNK-4, SNK-5, SNK-6, CHK-6).

The reference polls an HTTP feed and inserts each snapshot. Here every
snapshot is a staged JSON file; a Structured Streaming file source picks
new files up, and ``foreachBatch`` flattens each micro-batch into the six
fact tables. A batch is parsed once, into the shared folder, and fanned out
from there. What it writes becomes visible as one version of a commit log
(``sources.commits``): a batch adds a few files to each table, however many
polls it has. Rows carry their poll and the run that wrote them; a poll that
comes again, in whatever batch of whatever checkpoint, takes the place of its
earlier run in every table, also in those it has no rows for any more.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline.operators import realtime as R
from tramline.session import ensure_checkpoint_dir
from tramline.sources import commits as C
from tramline.sources.sinks import filesystem, path_exists, write_bucketed

COMMITTED = "committed_polls"
REPLACED = "replaced_polls"     # (poll, run) pairs whose rows no longer count
RUNS = "runs"                   # one row for each run: its summary
# Each fact table, the key whose first part is the poll id, and its sort column.
FACT_TABLES = {
    "trip_updates": ("update_pk", "trip_id"), "trip_stop_updates": ("update_pk", "stop_id"),
    "service_alerts": ("alert_pk", "entity_id"), "alert_active_periods": ("alert_pk", "alert_pk"),
    "alert_texts": ("alert_pk", "alert_pk"), "alert_informed_entities": ("alert_pk", "stop_id"),
}
SORT_COLUMNS = {t: c for t, (_, c) in FACT_TABLES.items()}
POLL_TABLES = (*FACT_TABLES, "summary", "rejected", COMMITTED)  # by poll and run
RETRIES = 20


def poll_stream(spark: SparkSession, path: str, feed: str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """STR-1/STR-2: a stream of poll files; ``fetched_at`` = header time, else file mtime."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return R.poll_columns(r.text(path, wholetext=True), feed)


def _parsed_once(batch: DataFrame, fetched: Observation) -> DataFrame:
    """The parsed polls of a batch, written to the shared folder: outputs read
    them there, and a lost executor costs no second parse. Counts the
    entities of the trip feed on the way."""
    spark = batch.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/polls-{uuid.uuid4().hex}"
    n = F.when(F.col("feed") == "trip-update", F.coalesce(F.size("msg.entity"), F.lit(0))).otherwise(0)
    n = F.when(n > 0, n).otherwise(0)  # the size of a missing list may be -1
    batch.observe(fetched, F.coalesce(F.sum(n), F.lit(0)).alias("total_trips_fetched")).write.parquet(path)
    return spark.read.schema(batch.schema).parquet(path)


def flatten_batch(batch: DataFrame, out_root: str, dim_stations: DataFrame | None = None,
                  station_filter=None, on_invalid: str = "strict") -> int | None:
    """SNK-4: one micro-batch -> one version of all fact tables. Returns it (None: an empty batch).

    ``strict`` (default, as the reference): a malformed poll, a NOT NULL
    break or an overlong value fails the batch before anything is visible;
    ``quarantine`` writes such rows to ``rejected``. The run's summary
    (SNK-6) is observed while the tables are written, and is a row of
    ``runs``; ``summary`` has a row for each poll.
    """
    spark = batch.sparkSession
    run = uuid.uuid4().hex
    fetched, trips_seen, alerts_seen = (Observation(f"{x}-{run}") for x in ("fetched", "trips", "alerts"))
    polls = _parsed_once(batch, fetched)
    scratch = polls.inputFiles()
    try:
        trips = polls.filter(F.col("feed") == "trip-update")
        alerts = polls.filter(F.col("feed") == "alert")
        tables = R.flatten(trips, alerts, dim_stations, station_filter, on_invalid=on_invalid,
                           carry={"fetched_at": "fetched_at"}, summary_by=["poll_id", "fetched_at"])
        seen = {"trip_updates": (trips_seen, "trips_inserted"), "service_alerts": (alerts_seen, "alerts_processed")}
        staged = []
        for name in (*FACT_TABLES, "summary", "rejected"):
            if name not in tables:
                continue
            rows = tables[name].withColumn("run", F.lit(run)).withColumn(C.DATE, F.to_date("fetched_at"))
            if name in FACT_TABLES:
                rows = rows.withColumn("poll_id", R.poll_of(FACT_TABLES[name][0]))
            if name in seen:
                rows = rows.observe(seen[name][0], F.count(F.lit(1)).alias(seen[name][1]))
            staged.append((rows, name))
        done = polls.select("poll_id", "feed", "source_file", "fetched_at").distinct().withColumn(
            "run", F.lit(run)).withColumn(C.DATE, F.to_date("fetched_at"))
        staged.append((done, COMMITTED))
        with ThreadPoolExecutor(len(staged)) as pool:  # independent jobs; small ones would wait for each other
            adds = list(pool.map(lambda x: C.stage(x[0], out_root, x[1], SORT_COLUMNS.get(x[1])), staged))
        if not adds[-1].paths:
            return None
        counts = {**fetched.get, "trips_inserted": 0, "alerts_processed": 0}
        for f in adds:  # a table without rows may have had no task to count in
            if f.table in seen and f.paths:
                counts |= seen[f.table][0].get
        adds.append(C.stage(_run_row(spark, run, station_filter, dim_stations, counts), out_root, RUNS))
        return _commit_polls(spark, out_root, adds, polls.select("poll_id").distinct())
    finally:
        _drop_folder(spark, scratch)


def _drop_folder(spark: SparkSession, files: list[str]) -> None:
    if files:
        fs, p = filesystem(spark, os.path.dirname(files[0]))
        fs.delete(p, True)


def _run_row(spark: SparkSession, run: str, station_filter, dim_stations: DataFrame | None, counts: dict) -> DataFrame:
    """The run summary (SNK-6) from what was counted while writing."""
    ids = R.resolve_station_ids(dim_stations, station_filter) if dim_stations is not None else None
    n = F.lit(0) if ids is None else ids.agg(F.count(F.lit(1))).scalar()
    row = spark.createDataFrame([(run, station_filter or R.NO_FILTER_LABEL, R.STATUS_OK, *(int(counts[c]) for c in R.COUNTS))],
                                f"run string, station_filter string, status string, {', '.join(f'{c} bigint' for c in R.COUNTS)}")
    return row.withColumn("resolved_stop_ids_count", n.cast("bigint")).withColumn(C.DATE, F.current_date())


def _commit_polls(spark: SparkSession, root: str, adds: list[C.Files], poll_ids: DataFrame) -> int:
    """Make staged files visible; earlier runs of the same polls are replaced in the same version."""
    for _ in range(RETRIES):
        version = C.latest_version(spark, root)
        extra = []
        if version:
            replaced = read_committed(spark, root, COMMITTED, version, with_run=True).join(poll_ids, "poll_id", "left_semi")
            found = C.stage(replaced.select("poll_id", "run", C.DATE), root, REPLACED)
            extra = [found] if found.paths else []
        try:
            return C.commit(spark, root, adds + extra, read_version=version)
        except C.Conflict:  # another stream committed meanwhile: it may have some of these polls
            continue
    raise C.Conflict(f"{RETRIES} other commits came in between")


def read_committed(spark: SparkSession, out_root: str, table: str, version: int | None = None, days=None,
                   with_run: bool = False) -> DataFrame:
    """A table as of a version (default: the newest): the rows of each poll's last run, from the files the log names."""
    version = C.latest_version(spark, out_root) if version is None else version
    rows = C.read_table(spark, out_root, table, version, days)
    if table in POLL_TABLES:
        rows = _without_replaced(spark, out_root, rows, version, days)
    return rows if with_run else rows.drop("run")


def _without_replaced(spark: SparkSession, root: str, rows: DataFrame, version: int, days=None) -> DataFrame:
    files = C.live_files(spark, root, version).where(F.col("table") == REPLACED)
    if days is not None:
        files = files.where(F.col("day").isin([str(d) for d in days]))
    paths = [r["path"] for r in files.collect()]
    if not paths:
        return rows
    gone = C.read_table(spark, root, REPLACED, version, paths=paths).select("poll_id", "run").distinct()
    return rows.join(gone, ["poll_id", "run"], "left_anti").select(*rows.columns)


def compact(spark: SparkSession, out_root: str, days=None, min_files: int = 2) -> int | None:
    """SNK-5: the live rows of each table's days in few files, sorted by its sort column, exchanged in one version.

    Running readers keep the files of their version. Days with fewer than
    ``min_files`` files in a table, and nothing replaced, are left alone.
    Returns the new version (None: nothing to do); a commit in between on the
    same days raises ``Conflict``.
    """
    version = C.latest_version(spark, out_root)
    files = C.live_files(spark, out_root, version).where(F.col("table").isin(REPLACED, *POLL_TABLES) & F.col("day").isNotNull())
    if days is not None:
        files = files.where(F.col("day").isin([str(d) for d in days]))
    by: dict[tuple[str, str], list[str]] = {}
    for r in files.collect():  # as many as files
        by.setdefault((r["table"], r["day"]), []).append(r["path"])
    stale = {day for table, day in by if table == REPLACED}
    tables, drop = {}, {}
    for table in POLL_TABLES:
        mine = {d: p for (t, d), p in by.items() if t == table and (d in stale or len(p) >= min_files)}
        if mine:
            paths = [x for p in mine.values() for x in p]
            rows = C.read_table(spark, out_root, table, version, paths=paths)
            tables[table] = (_without_replaced(spark, out_root, rows, version, list(mine)), paths, SORT_COLUMNS.get(table))
    for day in stale:  # every table of the day was rewritten without them
        drop.setdefault(REPLACED, []).extend(by[REPLACED, day])
    return C.rewrite(spark, out_root, tables, version, drop) if tables else None


def publish_bucketed(spark: SparkSession, out_root: str, path: str, prefix: str, buckets: int,
                     version: int | None = None, days=None) -> dict[str, str]:
    """SNK-5, J-9: the fact tables of one version as bucketed tables of the catalog.

    All are bucketed and sorted by the key of their parent, so that parents
    join children (``operators.joins.parent_child``) without a shuffle.
    Returns {fact table: name in the catalog}.
    """
    version = C.latest_version(spark, out_root) if version is None else version
    names = {}
    for table, (key, _) in FACT_TABLES.items():
        names[table] = f"{prefix}_{table}"
        write_bucketed(read_committed(spark, out_root, table, version, days), names[table], key, buckets,
                       os.path.join(path, names[table]))
    return names


def purge(spark: SparkSession, out_root: str, before: datetime) -> int | None:
    """CHK-6: delete all polls' rows fetched before a time, alerts and trips with their children (see ``commits.purge``).

    One version for all tables: readers never see a child without its parent.
    """
    return C.purge(spark, out_root, [
        ("trip_updates", "update_pk", ("trip_stop_updates",)),
        ("service_alerts", "alert_pk", R.ALERT_CHILDREN)],
        before, SORT_COLUMNS, others=("summary", "rejected", COMMITTED))


def start_ingest(spark: SparkSession, trip_dir: str, alert_dir: str, out_root: str,
                 checkpoint: str | None = None, dim_stations: DataFrame | None = None,
                 station_filter=None, available_now: bool = True,
                 max_files_per_trigger: int | None = None,
                 on_invalid: str = "strict") -> StreamingQuery:
    """Start the ingest stream over both feeds' staged poll folders."""
    polls = poll_stream(spark, trip_dir, "trip-update", max_files_per_trigger).unionByName(
        poll_stream(spark, alert_dir, "alert", max_files_per_trigger))
    ckpt = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "tramline-ingest")
    w = (polls.writeStream.option("checkpointLocation", ckpt)
         .foreachBatch(lambda df, _: flatten_batch(df, out_root, dim_stations,
                                                   station_filter, on_invalid)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 minutes")
    return w.start()


def service_day(start_date="start_date", fetched_at="fetched_at") -> Column:
    """The day a trip started: ``start_date``, else (absent, unreadable) the poll's day.

    A start date after the poll's day counts as that day, so that a wrong
    date far ahead cannot move the watermark.
    """
    named = F.try_to_date(start_date, "yyyyMMdd") if hasattr(F, "try_to_date") else \
        F.to_date(F.try_to_timestamp(F.col(start_date), F.lit("yyyyMMdd")))
    polled = F.to_date(fetched_at)
    return F.least(F.coalesce(named, polled), polled)


def latest_state_stream(trip_updates_stream: DataFrame, retention: str = "2 days") -> DataFrame:
    """STR-3: latest snapshot per (trip, start_date) as a streaming aggregate.

    ``max(struct(update_timestamp, ...))`` keeps the newest snapshot (ties
    broken by the following fields), whichever side of midnight a poll is.
    State is bounded: the service day is the event time, and a day's state
    goes once trips of a day ``retention`` later are seen. Run in ``update``
    output mode.
    """
    # Watermarks need TIMESTAMP (not NTZ); only its order matters here.
    s = (trip_updates_stream.withColumn("service_day", service_day())
         .withColumn("_event_ts", F.col("service_day").cast("timestamp"))
         .withWatermark("_event_ts", retention))
    latest = F.max(F.struct(*LATEST_COLS))
    g = s.groupBy("_event_ts", "service_day", "trip_id", "start_date").agg(
        latest.alias("_m"), F.count(F.lit(1)).alias("snapshots"))
    return g.select("service_day", "trip_id", "start_date",
                    *[F.col(f"_m.{c}").alias(c) for c in LATEST_COLS], "snapshots")


def trip_updates_stream(spark: SparkSession, trip_dir: str) -> DataFrame:
    """Trip headers as a stream (input of ``latest_state_stream``)."""
    ents = R.trip_update_entities(R.entities(poll_stream(spark, trip_dir, "trip-update")))
    return R.trip_updates(ents)


LATEST_COLS = ("update_timestamp", "fetched_at", "entity_id", "route_id", "overall_delay",
               "update_pk")


def upsert_latest(headers: DataFrame, table_path: str, keys=("trip_id", "start_date")) -> None:
    """STR-3 as a table: merge trip headers into the latest-snapshot-per-trip table.

    The table is partitioned by service day, which a trip keeps across
    midnight. Only the days present in ``headers`` are read back (partition
    pruning by semi-join), merged with the new rows, reduced to the newest
    row per key with one aggregate and rewritten with dynamic partition
    overwrite. The merged result is checkpointed first because the job reads
    and rewrites the same table.
    """
    spark = headers.sparkSession
    new = headers.withColumn("service_day", service_day()).select("service_day", *keys, *LATEST_COLS)
    both = new
    if path_exists(spark, table_path):
        days = new.select("service_day").distinct()
        both = spark.read.parquet(table_path).select(*new.columns).join(
            days, "service_day", "left_semi").unionByName(new)
    m = both.groupBy("service_day", *keys).agg(
        F.max(F.struct(*[F.col(c) for c in LATEST_COLS])).alias("_m"))
    latest = m.select("service_day", *keys, *[F.col("_m." + c).alias(c) for c in LATEST_COLS])
    (latest.checkpoint().write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("service_day").parquet(table_path))


def start_latest_table(spark: SparkSession, trip_dir: str, table_path: str,
                       checkpoint: str | None = None, available_now: bool = True
                       ) -> StreamingQuery:
    """Keep ``table_path`` = latest snapshot per (trip, start_date), batch by batch."""
    ckpt = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "tramline-latest")
    w = (trip_updates_stream(spark, trip_dir).writeStream
         .option("checkpointLocation", ckpt)
         .foreachBatch(lambda df, bid: upsert_latest(df, table_path)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 minutes")
    return w.start()
