"""Static-schedule questions Q1–Q5 and their building blocks.

Inputs are typed GTFS DataFrames (``routes``, ``trips``, ``stop_times``,
``stops``, ``calendar_dates``). Join strategy is left to Catalyst + AQE:
small dimension sides are broadcast only when Spark's size estimate (an
upper bound for filtered scans) or AQE's measured stage size is under the
broadcast threshold; otherwise a shuffle join is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.text import like_ascii_ci
from tramline.functions.timecols import (
    classify_frequency, frequency_rank, hour_of_text_time, parse_compact_date,
    service_seconds, week_bucket, WEEK_EPOCH,
)
from tramline.operators.aggregates import (
    count_if, modal_value, modal_value_row_number, percent, ratio, share_of_total,
    share_of_total_window,
)

RAIL = 2


# ---------------------------------------------------------------- Q1 blocks
def rail_routes(routes: DataFrame, route_type: int = RAIL) -> DataFrame:
    """F-1: routes of one GTFS route type."""
    return routes.filter(F.col("route_type") == F.lit(route_type))


def stop_times_with_routes(stop_times: DataFrame, trips: DataFrame, routes: DataFrame,
                           route_type: int | None = RAIL) -> DataFrame:
    """J-1: stop_times ⋈ trips ⋈ routes (inner), optionally one route type."""
    r = routes if route_type is None else rail_routes(routes, route_type)
    t = trips.select("trip_id", "route_id").join(r, "route_id")
    return stop_times.join(t, "trip_id")


def peak_departure_hours(stop_times: DataFrame, trips: DataFrame, routes: DataFrame,
                         route_type: int = RAIL, k: int = 3) -> DataFrame:
    """Q1: top-k departure hours by number of stop departures.

    The hour is the reference's text hour (NULL for 25:xx and malformed
    times, and NULL is a group of its own). Ties broken by hour.

    Plan: stop rows are first counted per (trip, hour) — a hash aggregate
    combined map-side, so a trip with huge numbers of stops collapses before
    any shuffle — then joined to the rail trips and summed per hour. The join
    never sees raw stop rows.
    """
    st = stop_times.select("trip_id", hour_of_text_time("departure_time").alias("departure_hour"))
    per_trip_hour = st.groupBy("trip_id", "departure_hour").agg(F.count(F.lit(1)).alias("_n"))
    rail = rail_routes(routes.select("route_id", "route_type"), route_type)
    t = trips.select("trip_id", "route_id").join(rail, "route_id").select("trip_id")
    j = per_trip_hour.join(t, "trip_id")
    return (j.groupBy("departure_hour").agg(F.sum("_n").cast("bigint").alias("departure_count"))
            .orderBy(F.col("departure_count").desc(), F.col("departure_hour").asc_nulls_last())
            .limit(k))


def stop_events_per_route(stop_times: DataFrame, trips: DataFrame, routes: DataFrame,
                          route_type: int | None = None) -> DataFrame:
    """J-1 aggregated: stop events and trips served per route.

    Stop rows are counted per trip first (map-side combined), so the joins
    see one row per trip instead of one per stop.
    """
    per_trip = stop_times.groupBy("trip_id").agg(F.count(F.lit(1)).alias("_n"))
    r = routes.select("route_id", "route_type")
    if route_type is not None:
        r = rail_routes(r, route_type)
    t = trips.select("trip_id", "route_id").join(r, "route_id")
    j = per_trip.join(t, "trip_id")
    return j.groupBy("route_id", "route_type").agg(
        F.sum("_n").cast("bigint").alias("stop_events"),
        F.count_distinct("trip_id").alias("trips_served"))


def trip_service_span(stop_times: DataFrame) -> DataFrame:
    """SC-2 in use: first and last departure of each trip in service seconds."""
    s = stop_times.select("trip_id", service_seconds("departure_time").alias("_s"))
    return s.groupBy("trip_id").agg(F.min("_s").alias("first_departure_s"),
                                    F.max("_s").alias("last_departure_s"))


# ---------------------------------------------------------------- Q2 blocks
def stations_matching(stops: DataFrame, text: str) -> DataFrame:
    """F-3: stops whose name contains ``text`` — SQLite LIKE, ASCII case-insensitive."""
    return stops.filter(like_ascii_ci("stop_name", f"%{text}%"))


def platforms_of(stops: DataFrame, station_text: str) -> DataFrame:
    """J-3: stops whose parent is a station matching the text (IN subquery)."""
    parents = stations_matching(stops, station_text).select(
        F.col("stop_id").alias("parent_station"))
    return stops.join(parents, "parent_station", "left_semi")


def busiest_platforms(stop_times: DataFrame, stops: DataFrame, station_text: str,
                      k: int = 3) -> DataFrame:
    """Q2: the top-k platforms of one station by number of stop events."""
    plats = (platforms_of(stops, station_text)
             .filter(F.col("platform_code").isNotNull())
             .select("stop_id", "platform_code"))
    # the platforms of one station (a few, which Spark can broadcast) reduce the
    # scan of stop_times; what is left is counted map-side
    j = stop_times.select("stop_id").join(plats, "stop_id")
    return (j.groupBy("platform_code").agg(F.count(F.lit(1)).alias("platform_usage_count"))
            .orderBy(F.col("platform_usage_count").desc(), F.col("platform_code").asc())
            .limit(k))


# ---------------------------------------------------------------- Q3 blocks
def first_stop_per_trip(stop_times: DataFrame) -> DataFrame:
    """J-4: the first stop (lowest stop_sequence) of every trip.

    One aggregate instead of the correlated ``seq = MIN(seq)`` subquery:
    ``min(struct(seq, dep IS NULL, dep))``. When a trip repeats its first
    sequence, the earliest recorded departure among those rows is kept and a
    NULL departure never hides a recorded one (T-6).
    """
    m = stop_times.groupBy("trip_id").agg(F.min(F.struct(
        F.col("stop_sequence"),
        F.col("departure_time").isNull().alias("no_dep"),
        F.col("departure_time").alias("dep"))).alias("_f"))
    return m.select("trip_id", F.col("_f.stop_sequence").alias("first_stop_sequence"),
                    F.col("_f.dep").alias("first_departure_time"))


def morning_destinations(trips: DataFrame, stop_times: DataFrame,
                         before: str = "12:00:00", k: int = 3) -> DataFrame:
    """Q3: top-k headsigns of trips whose first stop departs before ``before``.

    F-4: text comparison of fixed-width ``HH:MM:SS`` (``9:05:00`` is not
    before ``12:00:00``, as in the reference).
    """
    # The least of 2 * sequence + (0 if the departure is early): even where an
    # early departure is among the first stop's rows (T-6). A number, so the
    # minimum is a hash aggregate in one pass over stop_times.
    late = F.when(F.col("departure_time") < F.lit(before), 0).otherwise(1)
    least = F.min(F.col("stop_sequence").cast("bigint") * 2 + late).alias("_least")
    first = stop_times.groupBy("trip_id").agg(least).filter(F.col("_least") % 2 == 0).select("trip_id")
    j = trips.select("trip_id", "trip_headsign").join(first, "trip_id")
    return (j.groupBy("trip_headsign")
            .agg(F.count_distinct("trip_id").alias("trip_count"))
            .orderBy(F.col("trip_count").desc(), F.col("trip_headsign").asc_nulls_last())
            .limit(k))


def distinct_trips_per_headsign(trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """A-3: COUNT(DISTINCT trip_id) per headsign over trips ⋈ stop_times.

    Only the existence of a stop matters for a distinct count, so stop_times
    is reduced to its distinct trip ids (map-side) and semi-joined.
    """
    served = stop_times.select("trip_id").distinct()
    j = trips.select("trip_id", "trip_headsign").join(served, "trip_id", "left_semi")
    return j.groupBy("trip_headsign").agg(F.count_distinct("trip_id").alias("trip_count"))


# ---------------------------------------------------------------- Q4 blocks
def service_weeks(calendar_dates: DataFrame, epoch: str = WEEK_EPOCH,
                  floor: bool = False) -> DataFrame:
    """SC-3..SC-5: added service dates as DATE and their week bucket."""
    return (calendar_dates.filter(F.col("exception_type") == 1)
            .select("service_id", "date", parse_compact_date("date").alias("iso_date"))
            .withColumn("week_bucket", week_bucket("iso_date", epoch, floor)))


def days_per_week(calendar_dates: DataFrame, epoch: str = WEEK_EPOCH) -> DataFrame:
    """A-7 first level: operating days per (service, week)."""
    return (service_weeks(calendar_dates, epoch)
            .groupBy("service_id", "week_bucket")
            .agg(F.count(F.lit(1)).alias("operating_days")))


def typical_days_per_week(calendar_dates: DataFrame, use_window: bool = False) -> DataFrame:
    """A-8: each service's modal days-per-active-week, ties to the larger value."""
    dpw = days_per_week(calendar_dates)
    pick = modal_value_row_number if use_window else modal_value
    return pick(dpw, "service_id", "operating_days", "typical_days_per_week")


def classified_services(calendar_dates: DataFrame) -> DataFrame:
    """SC-6: frequency class per service."""
    return typical_days_per_week(calendar_dates).select(
        "service_id", classify_frequency("typical_days_per_week").alias("frequency_category"))


def typical_days_share(calendar_dates: DataFrame) -> DataFrame:
    """W-2: services per typical number of days and their share of all (at most seven rows)."""
    counts = typical_days_per_week(calendar_dates).groupBy("typical_days_per_week").agg(
        F.count(F.lit(1)).alias("service_count"))
    return share_of_total_window(counts, "service_count", "percentage")


def service_frequency(calendar_dates: DataFrame, window_total: bool = True) -> DataFrame:
    """Q4: services per frequency class and their share (2 decimals).

    Three classes at most, so the total is a window over three rows
    (``window_total=False`` uses the general A-9 form).
    """
    counts = (classified_services(calendar_dates).groupBy("frequency_category")
              .agg(F.count(F.lit(1)).alias("service_count")))
    share = share_of_total_window if window_total else share_of_total
    return (share(counts, "service_count", "percentage")
            .orderBy(frequency_rank("frequency_category")))


# ---------------------------------------------------------------- Q5 blocks
def amenity_counts(trips: DataFrame) -> DataFrame:
    """A-4/A-5: trip counts per route, pre-aggregated before any join."""
    b = F.col("bikes_allowed") == 1
    w = F.col("wheelchair_accessible") == 1
    return trips.groupBy("route_id").agg(
        F.count("trip_id").alias("total_trips"),
        count_if(b).alias("trips_with_bikes"),
        count_if(w).alias("trips_with_wheelchair"),
        count_if(b | w).alias("trips_with_any_amenity"),
    )


AMENITY_COLUMNS = ["total_trips", "trips_with_bikes", "trips_with_wheelchair",
                   "trips_with_any_amenity", "ratio_bikes", "ratio_wheelchair",
                   "ratio_any_amenity", "percentage_bikes", "percentage_wheelchair",
                   "percentage_any_amenity"]


def accessibility(routes: DataFrame, trips: DataFrame, with_names: bool = False) -> DataFrame:
    """Q5 body (J-6, A-10): per-route amenity counts, ratios and percentages.

    Routes without trips vanish (inner join), as in the reference.
    """
    keys = ["route_id", "route_short_name", "route_long_name"] if with_names else ["route_id"]
    j = routes.select(*keys).join(amenity_counts(trips), "route_id")
    return j.select(
        *keys, "total_trips", "trips_with_bikes", "trips_with_wheelchair",
        "trips_with_any_amenity",
        ratio("trips_with_bikes", "total_trips").alias("ratio_bikes"),
        ratio("trips_with_wheelchair", "total_trips").alias("ratio_wheelchair"),
        ratio("trips_with_any_amenity", "total_trips").alias("ratio_any_amenity"),
        percent("trips_with_bikes", "total_trips").alias("percentage_bikes"),
        percent("trips_with_wheelchair", "total_trips").alias("percentage_wheelchair"),
        percent("trips_with_any_amenity", "total_trips").alias("percentage_any_amenity"),
    )


def accessibility_sample(routes: DataFrame, trips: DataFrame, k: int = 20) -> DataFrame:
    """Q5 as logged: first k routes by route_id text (S-4)."""
    return accessibility(routes, trips).orderBy("route_id").limit(k)


def accessibility_ranked(routes: DataFrame, trips: DataFrame, k: int = 20) -> DataFrame:
    """Q5 ranked: the k routes with the lowest amenity share (S-3)."""
    return (accessibility(routes, trips, with_names=True)
            .orderBy(F.col("percentage_any_amenity").asc(), F.col("route_id").asc())
            .limit(k))


def preview(df: DataFrame, order_by: str, n: int = 5) -> DataFrame:
    """S-5: first rows after an explicit order."""
    return df.orderBy(order_by).limit(n)
