"""Punctuality measures over the real-time star (W-3, J-8, D-1..D-8).

Star: ``trip_stop_updates`` (fact, one row per stop of a polled trip) ->
``trip_updates`` (one row per poll snapshot of a trip) -> ``dim_trips`` ->
``dim_routes``; and fact -> ``dim_stations`` (soft reference, LEFT JOIN).

Plan shape: the snapshot headers are reduced first (latest snapshot per
trip, rail routes only) and joined to their dimensions while still small;
the fact then needs exactly one shuffle join, on ``update_pk``. Stations
join last, broadcast only if Spark measures them under the threshold.
Delays are summed as integer seconds and divided last (T-14).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.timecols import (
    ON_TIME_THRESHOLD_S, local_hour, on_time_flag, train_category,
)
from tramline.operators.aggregates import minutes, share_of_total_window

RAIL = 2
LOW_SAMPLE_TRAINS = 30  # D-8 default: flag groups built from fewer trains


# ---------------------------------------------------------------- W-3 latest
def latest_timestamps(trip_updates: DataFrame, keys=("trip_id",)) -> DataFrame:
    """Max ``update_timestamp`` per key — partially aggregated map-side."""
    return trip_updates.groupBy(*keys).agg(F.max("update_timestamp").alias("_latest_ts"))


def with_latest_flag(trip_updates: DataFrame, keys=("trip_id",)) -> DataFrame:
    """W-3 ``IsLatestUpdate``: TRUE on every snapshot holding the trip's max ts.

    Ties are all flagged. Aggregate + join instead of a window: a trip with
    very many snapshots is combined map-side and its rows are never sorted
    in one task (AQE splits a skewed join partition).
    """
    m = latest_timestamps(trip_updates, keys)
    j = trip_updates.join(m, list(keys), "left")
    return (j.withColumn("is_latest", F.coalesce(
        F.col("update_timestamp") == F.col("_latest_ts"), F.lit(False)))
        .drop("_latest_ts"))


def latest_updates(trip_updates: DataFrame, keys=("trip_id",)) -> DataFrame:
    """Only the latest snapshot(s) of each trip (filter form of W-3)."""
    m = latest_timestamps(trip_updates, keys)
    j = trip_updates.join(m, list(keys))
    return j.filter(F.col("update_timestamp") == F.col("_latest_ts")).drop("_latest_ts")


def latest_per_key(df: DataFrame, key: str, ts: str, cols) -> DataFrame:
    """STR-3 batch twin: the newest row per key as one aggregate.

    ``max(struct(ts, ...))``: ties on ``ts`` resolve by the next columns,
    so the answer is deterministic.
    """
    m = df.groupBy(key).agg(F.max(F.struct(F.col(ts), *[F.col(c) for c in cols])).alias("_m"))
    return m.select(key, F.col("_m." + ts).alias(ts), *[F.col("_m." + c).alias(c) for c in cols])


# --------------------------------------------------------------- J-8 the star
def trip_headers(trip_updates: DataFrame, dim_trips: DataFrame, dim_routes: DataFrame,
                 latest_only: bool = True, route_type: int | None = RAIL,
                 latest_keys=("trip_id",)) -> DataFrame:
    """Snapshot headers with their trip's route and train category.

    ``latest_keys``: the reference keys "latest" by trip only (T-8); pass
    ``("trip_id", "start_date")`` to keep one snapshot per trip and day.
    """
    tu = latest_updates(trip_updates, latest_keys) if latest_only else trip_updates
    r = dim_routes if route_type is None else dim_routes.filter(F.col("route_type") == route_type)
    r = r.select("route_id", "route_short_name",
                 train_category("route_short_name").alias("train_category"))
    trips = dim_trips.select("trip_id", "route_id").join(r, "route_id")
    return tu.select("update_pk", "trip_id", "update_timestamp").join(trips, "trip_id")


def star(stop_updates: DataFrame, trip_updates: DataFrame, dim_trips: DataFrame,
         dim_routes: DataFrame, dim_stations: DataFrame, latest_only: bool = True,
         route_type: int | None = RAIL, tz: str = "UTC", latest_keys=("trip_id",)) -> DataFrame:
    """J-8: one row per stop event with trip, route, category and station."""
    heads = trip_headers(trip_updates, dim_trips, dim_routes, latest_only, route_type,
                         latest_keys)
    f = stop_updates.join(heads, "update_pk")
    st = dim_stations.select("stop_id", "stop_name", "parent_station", "platform_code")
    f = f.join(st, "stop_id", "left")
    return (f.withColumn("arrival_hour", local_hour("arrival_time", tz))
             .withColumn("station_id", F.coalesce("parent_station", "stop_id")))


# ------------------------------------------------------------- partial sums
# Every measure below is a sum of these per-row quantities. Where a breakdown
# needs no more than the snapshot and the hour, the fact table is reduced to
# partial sums *before* the star join, which then sees a few rows per
# snapshot. With the stop in the key nothing would shrink, so there each row
# is its own partial and the fact table is shuffled once, on ``update_pk``.
PARTIALS = ("_events", "_recorded", "_on_time", "_delay_s", "_delayed_s")


def _partial_aggs(delay: str = "arrival_delay", threshold: int = ON_TIME_THRESHOLD_S):
    d = F.col(delay)
    return [F.count(F.lit(1)).alias("_events"), F.count(d).alias("_recorded"),
            F.count_if(on_time_flag(d, threshold)).alias("_on_time"),
            F.sum(d.cast("bigint")).alias("_delay_s"),
            F.sum(F.greatest(d, F.lit(0)).cast("bigint")).alias("_delayed_s")]


def as_partials(rows: DataFrame, delay: str = "arrival_delay",
                threshold: int = ON_TIME_THRESHOLD_S) -> DataFrame:
    """Stop rows as partials (each row a partial of itself)."""
    d = F.col(delay)
    return rows.withColumns({
        "_events": F.lit(1).cast("bigint"),
        "_recorded": F.when(d.isNotNull(), 1).otherwise(0).cast("bigint"),
        "_on_time": F.when(on_time_flag(d, threshold), 1).otherwise(0).cast("bigint"),
        "_delay_s": d.cast("bigint"),
        "_delayed_s": F.greatest(d, F.lit(0)).cast("bigint"),
    })


def star_partials(stop_updates: DataFrame, trip_updates: DataFrame, dim_trips: DataFrame,
                  dim_routes: DataFrame, dim_stations: DataFrame | None = None,
                  fact_keys=(), latest_only: bool = True, route_type: int | None = RAIL,
                  tz: str = "UTC", latest_keys=("trip_id",), stations_where=None) -> DataFrame:
    """J-8 for measures: partial sums per (update_pk, *fact_keys) joined to the star.

    ``fact_keys`` may name ``stop_id`` (then stations are joined) and
    ``arrival_hour`` (hour of arrival in ``tz``). ``stations_where``, a
    condition on the station columns, keeps those stations' rows alone: it is
    applied to the stations, whose few stops then reduce the fact scan before
    any fact row is shuffled on ``update_pk``.
    """
    fact = stop_updates
    if "arrival_hour" in fact_keys:
        fact = fact.withColumn("arrival_hour", local_hour("arrival_time", tz))
    heads = trip_headers(trip_updates, dim_trips, dim_routes, latest_only, route_type,
                         latest_keys)
    if "stop_id" not in fact_keys or dim_stations is None:
        return fact.groupBy("update_pk", *fact_keys).agg(*_partial_aggs()).join(heads, "update_pk")
    st = dim_stations.select("stop_id", "stop_name", "parent_station", "platform_code")
    rows = as_partials(fact).select("update_pk", *fact_keys, *PARTIALS)
    if stations_where is not None:
        j = rows.join(st.filter(stations_where), "stop_id").join(heads, "update_pk")
    else:
        j = rows.join(heads, "update_pk").join(st, "stop_id", "left")
    return j.withColumn("station_id", F.coalesce("parent_station", "stop_id"))


# ------------------------------------------------------------------ measures
def measure_columns():
    """A-12/A-13/A-15/A-16 columns shared by every breakdown (over partials)."""
    recorded = F.sum("_recorded")
    return [
        F.sum("_events").cast("bigint").alias("stop_events"),
        F.count_distinct("trip_id").alias("distinct_trains"),
        recorded.cast("bigint").alias("total_recorded"),
        F.sum("_on_time").cast("bigint").alias("on_time_count"),
        F.round(F.try_divide(F.sum("_on_time"), recorded), 4).alias("on_time_rate"),
        minutes(F.sum("_delay_s"), recorded).alias("avg_delay_min"),
    ]


def kpi_network(parts: DataFrame) -> DataFrame:
    """D-1: network on-time rate, coverage and volumes (one row)."""
    return parts.agg(*measure_columns(),
                     F.round(F.try_divide(F.sum("_recorded"), F.sum("_events")), 4
                             ).alias("delay_coverage"))


def _delayed_total():
    """A-14: early arrivals add 0 delayed seconds."""
    return F.coalesce(F.sum("_delayed_s"), F.lit(0).cast("bigint")).cast("bigint")


def kpi_by_category(parts: DataFrame) -> DataFrame:
    """D-2: per train category — average delay, total delayed minutes and share."""
    g = parts.groupBy("train_category").agg(
        *measure_columns(),
        F.count_distinct("route_id").alias("distinct_routes"),
        _delayed_total().alias("delayed_s"),
    )
    # at most four categories (IC, S, L, Other): the total is a window over them
    g = share_of_total_window(g, "delayed_s", "delay_share_pct")
    return g.withColumn("total_delayed_min", minutes(F.col("delayed_s"))).drop("delayed_s")


def delay_burden_by_category(parts: DataFrame) -> DataFrame:
    """A-14: delayed minutes per category and each category's share."""
    g = parts.groupBy("train_category").agg(_delayed_total().alias("delayed_s"))
    # at most four categories (IC, S, L, Other): the total is a window over them
    g = share_of_total_window(g, "delayed_s", "delay_share_pct")
    return g.withColumn("total_delayed_min", minutes(F.col("delayed_s"))).drop("delayed_s")


def delay_coverage(parts: DataFrame, by: str = "train_category") -> DataFrame:
    """A-16: recorded vs missing delays per group."""
    ev, rec = F.sum("_events"), F.sum("_recorded")
    return parts.groupBy(by).agg(
        ev.cast("bigint").alias("stop_events"),
        rec.cast("bigint").alias("total_recorded"),
        (ev - rec).cast("bigint").alias("missing"),
        F.round(F.lit(100.0) * rec / ev, 2).alias("coverage_pct"),
    )


def routes_per_category(parts: DataFrame) -> DataFrame:
    """A-17: distinct routes per train category."""
    return parts.groupBy("train_category").agg(
        F.count_distinct("route_id").alias("distinct_routes"))


def hourly_matrix(parts: DataFrame) -> DataFrame:
    """D-3: nationwide hour x (stop events, average delay); partials keyed by arrival_hour."""
    return parts.groupBy("arrival_hour").agg(*measure_columns())


def station_rows(star_df: DataFrame, station_name: str) -> DataFrame:
    """Rows of one station (slicer on the station name)."""
    return star_df.filter(F.col("stop_name") == F.lit(station_name))


def platform_congestion(star_df: DataFrame, station_name: str) -> DataFrame:
    """D-4: per platform of one station — average delay, on-time rate, trains."""
    return station_rows(star_df, station_name).groupBy("platform_code").agg(*measure_columns())


def station_hourly_volume(star_df: DataFrame, station_name: str) -> DataFrame:
    """D-5: hourly stop events and trains at one station."""
    return station_rows(star_df, station_name).groupBy("arrival_hour").agg(
        F.sum("_events").cast("bigint").alias("stop_events"),
        F.count_distinct("trip_id").alias("distinct_trains"))


def curated_rows(star_df: DataFrame, names) -> DataFrame:
    """F-10: rows of a curated list of station names (a short literal list)."""
    return star_df.filter(F.col("stop_name").isin(list(names)))


def station_ranking(star_df: DataFrame, names, low_sample: int = LOW_SAMPLE_TRAINS) -> DataFrame:
    """D-6: on-time ranking of the curated stations, with sample size.

    The rank is computed on the aggregated rows — at most ``len(names)``.
    """
    from pyspark.sql import Window
    g = curated_rows(star_df, names).groupBy("stop_name").agg(*measure_columns())
    g = g.withColumn("low_sample", F.col("distinct_trains") < F.lit(low_sample))
    w = Window.orderBy(F.col("on_time_rate").desc_nulls_last(), F.col("stop_name"))
    return g.withColumn("rank", F.row_number().over(w))


def busy_multi_platform_stations(star_df: DataFrame, k: int = 7) -> DataFrame:
    """A-18: stations with more than one platform and the most stop events."""
    g = star_df.groupBy("station_id").agg(
        F.count_distinct("platform_code").alias("n_platforms"),
        F.sum("_events").cast("bigint").alias("stop_events"))
    return (g.filter(F.col("n_platforms") > 1)
            .orderBy(F.col("stop_events").desc(), F.col("station_id")).limit(k))


def station_peak_hour(star_df: DataFrame, k: int = 7) -> DataFrame:
    """D-7: the hour with the highest average delay at each busy station.

    The star is reduced once to (station, platform, hour); a station's
    entries (at most its platforms times 24) give both whether it is busy
    (A-18) and its hours. Ties go to the later hour.
    """
    base = star_df.groupBy("station_id", "platform_code", "arrival_hour").agg(
        *[F.sum(c).alias(c) for c in ("_events", "_recorded", "_delay_s")])
    per_station = base.groupBy("station_id").agg(
        F.count_distinct("platform_code").alias("n_platforms"), F.sum("_events").alias("stop_events"),
        F.collect_list(F.struct("arrival_hour", "_delay_s", "_recorded")).alias("hours"))
    busy = (per_station.filter(F.col("n_platforms") > 1)
            .orderBy(F.col("stop_events").desc(), F.col("station_id")).limit(k))
    per_hour = busy.select("station_id", F.inline("hours")).groupBy("station_id", "arrival_hour").agg(
        F.try_divide(F.sum("_delay_s"), F.sum("_recorded")).alias("_avg_s"),
        F.sum("_recorded").alias("_n")).filter(F.col("_n") > 0)
    best = per_hour.groupBy("station_id").agg(F.max(F.struct("_avg_s", "arrival_hour")).alias("_b"))
    return best.select("station_id", F.col("_b.arrival_hour").alias("peak_hour"),
                       F.round(F.col("_b._avg_s") / F.lit(60.0), 4).alias("peak_avg_delay_min"))


def low_sample_flag(star_df: DataFrame, by=("stop_name", "platform_code"),
                    low_sample: int = LOW_SAMPLE_TRAINS) -> DataFrame:
    """D-8: averages with their sample size and a low-sample flag (not hidden)."""
    return (star_df.groupBy(*by).agg(*measure_columns())
            .withColumn("low_sample", F.col("distinct_trains") < F.lit(low_sample)))


def canonical_station(star_df: DataFrame, stations: DataFrame,
                      translations: DataFrame | None = None, language: str = "en") -> DataFrame:
    """SC-14: one row per physical station (parent or itself) with its name.

    The name is the station row's name, translated when a translation exists.
    """
    from tramline.operators.joins import translate_names
    names = stations.select(F.col("stop_id").alias("station_id"), "stop_name")
    if translations is not None:
        names = translate_names(names, translations, language).select(
            "station_id", F.col("display_name").alias("canonical_name"))
    else:
        names = names.select("station_id", F.col("stop_name").alias("canonical_name"))
    g = star_df.groupBy("station_id").agg(
        F.count_distinct("stop_id").alias("n_stop_ids"),
        F.sum("_events").cast("bigint").alias("stop_events"))
    return g.join(names, "station_id", "left")
