"""Checked queries: cleaning, dimensions and integrity (CLN-*, J-5, KEY/CHK-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions.text import clean_digits, clean_text, default_fill, default_route_type
from tramline.operators import dims as D
from tramline.operators import quality as Q
from tramline.plans.catalog import register
from tramline.sources import standins as X
from tramline.sources.gtfs import project_to_schema
from tramline.sources.schemas import FACT_WIDTHS
from tramline.sources.standins import sql_with
from tramline.sources.tables import read_table

PART_SCHEMA = [("p_partkey", "int"), ("p_name", "str"), ("p_size", "int"),
               ("p_retailprice", "float"), ("p_container", "str")]
PURGE_BEFORE = "1997-01-01"  # CHK-6 retention: snapshots older than this go

# DuckDB twins of the cleaning column builders (ASCII whitespace fixtures).
def _strip(c):
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _clean(c, n=None):
    s = f"NULLIF({_strip(c)}, '')"
    return f"left({s}, {n})" if n else s


def _digits(c):
    s = _strip(c)
    return f"(CASE WHEN regexp_matches({s}, '^[0-9]+$') THEN TRY_CAST({s} AS INTEGER) END)"


_DIM_ROUTES = f"""
SELECT {_clean('route_id', 50)} AS route_id, {_clean('agency_id', 30)} AS agency_id,
       {_clean('route_short_name', 50)} AS route_short_name,
       {_clean('route_long_name', 200)} AS route_long_name,
       COALESCE(NULLIF({_digits('route_type')}, 0), 2) AS route_type
FROM raw_routes_text"""
_CLEAN_TRIPS = f"""
SELECT {_clean('trip_id', 100)} AS trip_id, {_clean('route_id', 50)} AS route_id,
       COALESCE({_clean('service_id', 50)}, 'UNKNOWN') AS service_id,
       {_clean('trip_headsign', 150)} AS trip_headsign,
       {_digits('bikes_allowed')} AS bikes_allowed,
       {_digits('wheelchair_accessible')} AS wheelchair_accessible
FROM raw_trips_text"""
_TRIPS_SQL = sql_with("raw_routes_partial_text", "raw_trips_text",
                      extra={"dim_routes": _DIM_ROUTES.replace("raw_routes_text", "raw_routes_partial_text"), "clean_trips": _CLEAN_TRIPS})


def _dims(spark, d):
    routes = D.dim_routes(X.raw_routes_partial_text(spark, d))
    return routes, X.raw_trips_text(spark, d)


# ------------------------------------------------------------------ CLN-*
@register("project_to_schema", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size END AS p_size,
       p_retailprice, CAST(NULL AS VARCHAR) AS p_container
FROM part""")
def project_to_schema_q(spark, d):
    return project_to_schema(X.part_text(spark, d), PART_SCHEMA, strict=True)


@register("cast_strict", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size END AS p_size, p_retailprice
FROM part""")
def cast_strict_q(spark, d):
    from tramline.functions.text import cast_strict
    p = X.part_text(spark, d)
    return p.select(cast_strict("p_partkey", "int").alias("p_partkey"),
                    cast_strict("p_size", "int").alias("p_size"),
                    cast_strict("p_retailprice", "double").alias("p_retailprice"))


@register("clean_text", sql_with("customer_text") + f"""
SELECT c_custkey, {_clean('name_raw', 12)} AS name_clean FROM customer_text""")
def clean_text_q(spark, d):
    c = X.customer_text(spark, d)
    return c.select("c_custkey", clean_text("name_raw", 12).alias("name_clean"))


@register("clean_digits", sql_with("customer_text") + f"""
SELECT c_custkey, {_digits('digits_raw')} AS digits_value FROM customer_text""")
def clean_digits_q(spark, d):
    c = X.customer_text(spark, d)
    return c.select("c_custkey", clean_digits("digits_raw").alias("digits_value"))


@register("default_fill", sql_with("raw_trips_text") + f"""
SELECT {_clean('trip_id', 100)} AS trip_id,
       COALESCE({_clean('service_id', 50)}, 'UNKNOWN') AS service_id
FROM raw_trips_text""")
def default_fill_q(spark, d):
    t = X.raw_trips_text(spark, d)
    return t.select(clean_text("trip_id", 100).alias("trip_id"),
                    default_fill(clean_text("service_id", 50), "UNKNOWN").alias("service_id"))


@register("default_route_type", sql_with("raw_routes_text") + f"""
SELECT {_clean('route_id', 50)} AS route_id, route_type AS route_type_raw,
       COALESCE(NULLIF({_digits('route_type')}, 0), 2) AS route_type
FROM raw_routes_text""")
def default_route_type_q(spark, d):
    r = X.raw_routes_text(spark, d)
    return r.select(clean_text("route_id", 50).alias("route_id"),
                    F.col("route_type").alias("route_type_raw"),
                    default_route_type(clean_digits("route_type")).alias("route_type"))


@register("drop_empty_columns", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
       CASE WHEN p_partkey % 11 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS p_size,
       CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS VARCHAR) AS p_retailprice, ' ' AS p_mfgr
FROM part""")
def drop_empty_columns_q(spark, d):
    parts = X.part_text(spark, d)
    price = F.col("p_retailprice").cast("decimal(18,2)").cast("string")  # one text form in both engines
    return Q.drop_empty_columns(parts.withColumn("p_retailprice", price))


# ------------------------------------------------------------ dimensions
@register("dim_stations", sql_with("raw_stops_text") + f"""
SELECT {_clean('stop_id', 50)} AS stop_id,
       COALESCE({_clean('stop_name', 150)}, 'Unknown Station') AS stop_name,
       {_clean('parent_station', 50)} AS parent_station,
       {_clean('platform_code', 20)} AS platform_code,
       {_digits('wheelchair_boarding')} AS wheelchair_boarding
FROM raw_stops_text""")
def dim_stations_q(spark, d):
    return D.dim_stations(X.raw_stops_text(spark, d))


@register("dim_routes", sql_with("raw_routes_text") + _DIM_ROUTES)
def dim_routes_q(spark, d):
    return D.dim_routes(X.raw_routes_text(spark, d))


@register("dim_trips", _TRIPS_SQL + """
SELECT * FROM clean_trips WHERE route_id IN (SELECT route_id FROM dim_routes)""")
def dim_trips_q(spark, d):
    routes, raw = _dims(spark, d)
    kept, _ = D.dim_trips(raw, routes)
    return kept


@register("orphan_trips_kept", _TRIPS_SQL + """
SELECT trip_id, route_id FROM clean_trips
WHERE route_id IN (SELECT route_id FROM dim_routes)""")
def orphan_trips_kept(spark, d):
    routes, raw = _dims(spark, d)
    kept, _ = D.dim_trips(raw, routes)
    return kept.select("trip_id", "route_id")


@register("orphan_trips_rejected", _TRIPS_SQL + """
SELECT COUNT(*) FILTER (WHERE route_id IN (SELECT route_id FROM dim_routes)) AS kept,
       COUNT(*) FILTER (WHERE route_id IS NULL
                        OR route_id NOT IN (SELECT route_id FROM dim_routes)) AS rejected
FROM clean_trips""")
def orphan_trips_rejected(spark, d):
    routes, raw = _dims(spark, d)
    return D.dim_trips_counts(raw, routes)


# ------------------------------------------------------------ integrity
@register("fk_violations", sql_with(
    "routes_partial", "trips", "trips_partial", "stop_times", "stops", "stops_partial") + """
SELECT 'trips' AS child_table, 'route_id' AS child_column, 'routes' AS parent_table,
       COUNT(*) AS violations
FROM trips t WHERE t.route_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM routes_partial r WHERE r.route_id = t.route_id)
UNION ALL
SELECT 'stop_times', 'trip_id', 'trips', COUNT(*) FROM stop_times st
WHERE st.trip_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM trips_partial t WHERE t.trip_id = st.trip_id)
UNION ALL
SELECT 'stop_times', 'stop_id', 'stops', COUNT(*) FROM stop_times st
WHERE st.stop_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stops_partial s WHERE s.stop_id = st.stop_id)
UNION ALL
SELECT 'stops', 'parent_station', 'stops', COUNT(*) FROM stops c
WHERE c.parent_station IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM stops_partial p WHERE p.stop_id = c.parent_station)""")
def fk_violations(spark, d):
    trips, st, stops = X.trips(spark, d), X.stop_times(spark, d), X.stops(spark, d)
    some_trips, some_stops = X.trips_partial(spark, d), X.stops_partial(spark, d)
    return Q.fk_report([
        ("trips", trips, "route_id", "routes", X.routes_partial(spark, d), "route_id"),
        ("stop_times", st, "trip_id", "trips", some_trips, "trip_id"),
        ("stop_times", st, "stop_id", "stops", some_stops, "stop_id"),
        ("stops", stops, "parent_station", "stops", some_stops, "stop_id"),
    ])


@register("cascade_purge", sql_with("fact_trip_updates", "fact_stop_updates") + f"""
SELECT (SELECT COUNT(*) FROM fact_trip_updates
        WHERE update_timestamp < TIMESTAMP '{PURGE_BEFORE}') AS purged_parents,
       (SELECT COUNT(*) FROM fact_trip_updates
        WHERE NOT (update_timestamp < TIMESTAMP '{PURGE_BEFORE}')
           OR update_timestamp IS NULL) AS kept_parents,
       (SELECT COUNT(*) FROM fact_stop_updates f WHERE f.update_pk NOT IN (
            SELECT update_pk FROM fact_trip_updates
            WHERE update_timestamp < TIMESTAMP '{PURGE_BEFORE}')) AS kept_children""")
def cascade_purge(spark, d):
    cond = F.col("update_timestamp") < F.lit(PURGE_BEFORE).cast("timestamp_ntz")
    kp, kc, purged = Q.cascade_purge(X.fact_trip_updates(spark, d).select("update_pk", "update_timestamp"),
                                     X.fact_stop_updates(spark, d).select("update_pk"),
                                     "update_pk", cond)
    tag = lambda df, k: df.select(F.lit(k).alias("_k"))
    u = tag(purged, "p").unionByName(tag(kp, "kp")).unionByName(tag(kc, "kc"))
    k = F.col("_k")
    return u.agg(F.count_if(k == "p").alias("purged_parents"),
                 F.count_if(k == "kp").alias("kept_parents"),
                 F.count_if(k == "kc").alias("kept_children"))


@register("pk_violations", sql_with("stop_times") + """
SELECT trip_id, stop_sequence, COUNT(*) AS n_rows FROM stop_times
GROUP BY trip_id, stop_sequence HAVING COUNT(*) > 1""")
def pk_violations(spark, d):
    return Q.pk_violations(X.stop_times(spark, d), ["trip_id", "stop_sequence"])


@register("alert_poll_unique", """
SELECT CAST(user_id AS VARCHAR) AS entity_id, strftime(ts, '%Y-%m-%d %H:00:00') AS fetched_at,
       COUNT(*) AS n_rows
FROM events GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def alert_poll_unique(spark, d):
    e = read_table(spark, d, "events", "user_id", "ts").select(
        F.col("user_id").cast("string").alias("entity_id"),
        F.date_format("ts", "yyyy-MM-dd HH:00:00").alias("fetched_at"))
    return Q.unique_per_poll(e)


_NN_COLS = ["id", "update_pk", "stop_sequence", "stop_id"]


@register("not_null_violations", sql_with("stop_updates_with_nulls") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
    f"FROM stop_updates_with_nulls" for c in _NN_COLS))
def not_null_violations(spark, d):
    return Q.not_null_violations(X.stop_updates_with_nulls(spark, d), _NN_COLS)


_WIDTHS = {c: n for c, n in FACT_WIDTHS["trip_updates"].items()
           if c in ("entity_id", "start_date", "start_time", "vehicle_id", "license_plate")}


@register("width_violations", sql_with("trip_updates_text") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE length({c}) > {n}) AS violations "
    f"FROM trip_updates_text" for c, n in _WIDTHS.items()))
def width_violations(spark, d):
    return Q.width_violations(X.trip_updates_text(spark, d), _WIDTHS)
