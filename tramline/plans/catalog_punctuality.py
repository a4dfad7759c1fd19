"""Checked queries: punctuality star and dashboard measures (W-3, J-7, J-8, D-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions.timecols import CATEGORY_PATTERN, on_time_flag, train_category
from tramline.operators.joins import left_join_stations
from tramline.plans import punctuality as P
from tramline.plans.catalog import register
from tramline.sources import standins as X
from tramline.sources.standins import sql_with

STATION = "NATION_7"  # D-4/D-5 slicer (stand-in for one station name)
# Curated station list (stand-in for the dashboard's hand-picked names).
CURATED = ["NATION_0", "NATION_3", "NATION_7", "NATION_12", "NATION_18", "NATION_21",
           "NATION_24"]


def _star(spark, d, latest_only=True):
    """Row-level star (J-8)."""
    return P.star(X.fact_stop_updates(spark, d), X.fact_trip_updates(spark, d),
                  X.star_dim_trips(spark, d), X.star_dim_routes(spark, d), X.stops(spark, d),
                  latest_only=latest_only)


def _parts(spark, d, keys=(), latest_only=True, where=None):
    """Star over partial sums, keyed by the fact-side dimensions named; ``where``: on stations."""
    return P.star_partials(X.fact_stop_updates(spark, d), X.fact_trip_updates(spark, d),
                           X.star_dim_trips(spark, d), X.star_dim_routes(spark, d),
                           X.stops(spark, d), fact_keys=keys, latest_only=latest_only,
                           stations_where=where)


_CAT = f"COALESCE(regexp_extract(r.route_short_name, '{CATEGORY_PATTERN}', 1), '')"


def _star_sql(latest_only: bool = True, extra: dict | None = None) -> str:
    tu = "latest_tu" if latest_only else "fact_trip_updates"
    ctes = {
        "latest_tu": """
SELECT tu.* FROM fact_trip_updates tu
JOIN (SELECT trip_id, MAX(update_timestamp) AS m FROM fact_trip_updates GROUP BY trip_id) x
  ON tu.trip_id = x.trip_id AND tu.update_timestamp = x.m""",
        "star": f"""
SELECT f.update_pk, f.stop_sequence, f.stop_id, f.arrival_time, f.arrival_delay,
       tu.trip_id, r.route_id, r.route_short_name,
       CASE WHEN {_CAT} = '' THEN 'Other' ELSE {_CAT} END AS train_category,
       s.stop_name, s.parent_station, s.platform_code,
       CAST(hour(f.arrival_time) AS INTEGER) AS arrival_hour,
       COALESCE(s.parent_station, f.stop_id) AS station_id
FROM fact_stop_updates f
JOIN {tu} tu ON f.update_pk = tu.update_pk
JOIN star_dim_trips dt ON tu.trip_id = dt.trip_id
JOIN star_dim_routes r ON dt.route_id = r.route_id AND r.route_type = 2
LEFT JOIN stops s ON f.stop_id = s.stop_id""",
    }
    ctes.update(extra or {})
    return sql_with("fact_stop_updates", "fact_trip_updates", "star_dim_trips",
                    "star_dim_routes", "stops", extra=ctes)


_MEASURES = """
COUNT(*) AS stop_events, COUNT(DISTINCT trip_id) AS distinct_trains,
COUNT(arrival_delay) AS total_recorded,
COUNT(*) FILTER (WHERE arrival_delay < 120) AS on_time_count,
ROUND(CAST(COUNT(*) FILTER (WHERE arrival_delay < 120) AS DOUBLE)
      / NULLIF(COUNT(arrival_delay), 0), 4) AS on_time_rate,
ROUND(CAST(SUM(arrival_delay) AS DOUBLE) / NULLIF(60.0 * COUNT(arrival_delay), 0), 4)
  AS avg_delay_min"""

_DELAYED = "COALESCE(CAST(SUM(GREATEST(arrival_delay, 0)) AS BIGINT), 0)"
_SHARE = ("ROUND(100.0 * CAST(delayed_s AS DOUBLE) / "
          "NULLIF(CAST(SUM(delayed_s) OVER () AS DOUBLE), 0), 2)")


# ------------------------------------------------------------------- KPIs
@register("kpi_network", _star_sql() + f"""
SELECT {_MEASURES},
       ROUND(CAST(COUNT(arrival_delay) AS DOUBLE) / NULLIF(COUNT(*), 0), 4) AS delay_coverage
FROM star""")
def kpi_network(spark, d):
    return P.kpi_network(_parts(spark, d))


@register("kpi_by_category", _star_sql() + f"""
SELECT train_category, stop_events, distinct_trains, total_recorded, on_time_count,
       on_time_rate, avg_delay_min, distinct_routes,
       {_SHARE} AS delay_share_pct,
       ROUND(CAST(delayed_s AS DOUBLE) / 60.0, 4) AS total_delayed_min
FROM (SELECT train_category, {_MEASURES}, COUNT(DISTINCT route_id) AS distinct_routes,
             {_DELAYED} AS delayed_s
      FROM star GROUP BY train_category)""")
def kpi_by_category(spark, d):
    return P.kpi_by_category(_parts(spark, d))


@register("delay_burden_by_category", _star_sql() + f"""
SELECT train_category, {_SHARE} AS delay_share_pct,
       ROUND(CAST(delayed_s AS DOUBLE) / 60.0, 4) AS total_delayed_min
FROM (SELECT train_category, {_DELAYED} AS delayed_s FROM star GROUP BY train_category)""")
def delay_burden_by_category(spark, d):
    return P.delay_burden_by_category(_parts(spark, d))


@register("delay_coverage", _star_sql() + """
SELECT train_category, COUNT(*) AS stop_events, COUNT(arrival_delay) AS total_recorded,
       COUNT(*) FILTER (WHERE arrival_delay IS NULL) AS missing,
       ROUND(100.0 * CAST(COUNT(arrival_delay) AS DOUBLE) / COUNT(*), 2) AS coverage_pct
FROM star GROUP BY train_category""")
def delay_coverage(spark, d):
    return P.delay_coverage(_parts(spark, d))


@register("routes_per_category", _star_sql() + """
SELECT train_category, COUNT(DISTINCT route_id) AS distinct_routes
FROM star GROUP BY train_category""")
def routes_per_category(spark, d):
    return P.routes_per_category(_parts(spark, d))


@register("on_time_flag", _star_sql() + """
SELECT CASE WHEN arrival_delay IS NOT NULL THEN arrival_delay < 120 END AS on_time,
       COUNT(*) AS n
FROM star GROUP BY 1""")
def on_time_flag_q(spark, d):
    s = _star(spark, d)
    return s.groupBy(on_time_flag("arrival_delay").alias("on_time")).agg(
        F.count(F.lit(1)).alias("n"))


@register("on_time_rate", _star_sql(latest_only=False) + """
SELECT COUNT(*) FILTER (WHERE arrival_delay < 120) AS on_time_count,
       COUNT(arrival_delay) AS total_recorded,
       ROUND(CAST(COUNT(*) FILTER (WHERE arrival_delay < 120) AS DOUBLE)
             / NULLIF(COUNT(arrival_delay), 0), 4) AS on_time_rate
FROM star""")
def on_time_rate(spark, d):
    """A-12 over every snapshot (latest_only=False, T-7's other setting)."""
    s = _parts(spark, d, latest_only=False)
    return P.kpi_network(s).select("on_time_count", "total_recorded", "on_time_rate")


@register("train_category", sql_with("routes") + f"""
SELECT r.route_id, r.route_short_name,
       CASE WHEN {_CAT} = '' THEN 'Other' ELSE {_CAT} END AS train_category
FROM routes r""")
def train_category_q(spark, d):
    r = X.routes(spark, d)
    return r.select("route_id", "route_short_name",
                    train_category("route_short_name").alias("train_category"))


@register("star_join", _star_sql() + """
SELECT update_pk, stop_sequence, stop_id, trip_id, route_id, train_category, stop_name,
       platform_code, arrival_delay, arrival_hour
FROM star""")
def star_join(spark, d):
    return _star(spark, d).select(
        "update_pk", "stop_sequence", "stop_id", "trip_id", "route_id", "train_category",
        "stop_name", "platform_code", "arrival_delay", "arrival_hour")


@register("low_sample_flag", _star_sql() + f"""
SELECT stop_name, platform_code, {_MEASURES}, COUNT(DISTINCT trip_id) < 30 AS low_sample
FROM star GROUP BY stop_name, platform_code""")
def low_sample_flag(spark, d):
    return P.low_sample_flag(_parts(spark, d, ("stop_id",)))


# ------------------------------------------------------------ hour / station
@register("hourly_matrix", _star_sql() + f"""
SELECT arrival_hour, {_MEASURES} FROM star GROUP BY arrival_hour""")
def hourly_matrix(spark, d):
    return P.hourly_matrix(_parts(spark, d, ("arrival_hour",)))


@register("platform_congestion", _star_sql() + f"""
SELECT platform_code, {_MEASURES} FROM star WHERE stop_name = '{STATION}'
GROUP BY platform_code""")
def platform_congestion(spark, d):
    return P.platform_congestion(_parts(spark, d, ("stop_id",), where=F.col("stop_name") == STATION), STATION)


@register("station_hourly_volume", _star_sql() + f"""
SELECT arrival_hour, COUNT(*) AS stop_events, COUNT(DISTINCT trip_id) AS distinct_trains
FROM star WHERE stop_name = '{STATION}' GROUP BY arrival_hour""")
def station_hourly_volume(spark, d):
    return P.station_hourly_volume(
        _parts(spark, d, ("stop_id", "arrival_hour"), where=F.col("stop_name") == STATION), STATION)


_CURATED = "stop_name IN (" + ", ".join(f"'{n}'" for n in CURATED) + ")"
_CURATED_SQL = ", ".join(f"'{n}'" for n in CURATED)


@register("curated_stations", _star_sql() + f"""
SELECT stop_name, COUNT(*) AS stop_events, COUNT(DISTINCT trip_id) AS distinct_trains
FROM star WHERE stop_name IN ({_CURATED_SQL}) GROUP BY stop_name""")
def curated_stations(spark, d):
    return P.curated_rows(_parts(spark, d, ("stop_id",), where=_CURATED), CURATED).groupBy("stop_name").agg(
        F.sum("_events").cast("bigint").alias("stop_events"),
        F.count_distinct("trip_id").alias("distinct_trains"))


@register("station_ranking", _star_sql() + f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY on_time_rate DESC NULLS LAST, stop_name) AS rank
FROM (SELECT stop_name, {_MEASURES}, COUNT(DISTINCT trip_id) < 30 AS low_sample
      FROM star WHERE stop_name IN ({_CURATED_SQL}) GROUP BY stop_name)""")
def station_ranking(spark, d):
    return P.station_ranking(_parts(spark, d, ("stop_id",), where=_CURATED), CURATED)


_BUSY = """
SELECT station_id, n_platforms, stop_events FROM (
  SELECT station_id, COUNT(DISTINCT platform_code) AS n_platforms, COUNT(*) AS stop_events
  FROM star GROUP BY station_id)
WHERE n_platforms > 1 ORDER BY stop_events DESC, station_id LIMIT 7"""


@register("busy_multi_platform_stations", _star_sql(extra={"busy": _BUSY}) + """
SELECT * FROM busy""")
def busy_multi_platform_stations(spark, d):
    return P.busy_multi_platform_stations(_parts(spark, d, ("stop_id",)))


@register("station_peak_hour", _star_sql(extra={"busy": _BUSY}) + """
SELECT station_id, arrival_hour AS peak_hour, ROUND(avg_s / 60.0, 4) AS peak_avg_delay_min
FROM (SELECT station_id, arrival_hour, avg_s,
             ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY avg_s DESC, arrival_hour DESC)
               AS rn
      FROM (SELECT station_id, arrival_hour,
                   CAST(SUM(arrival_delay) AS DOUBLE) / COUNT(arrival_delay) AS avg_s
            FROM star WHERE station_id IN (SELECT station_id FROM busy)
            GROUP BY station_id, arrival_hour HAVING COUNT(arrival_delay) > 0))
WHERE rn = 1""")
def station_peak_hour(spark, d):
    return P.station_peak_hour(_parts(spark, d, ("stop_id", "arrival_hour")))


@register("canonical_station", _star_sql(extra={"translations": X.SQL["translations"]}) + """
SELECT g.station_id, g.n_stop_ids, g.stop_events,
       COALESCE(tr.translation, s.stop_name) AS canonical_name
FROM (SELECT station_id, COUNT(DISTINCT stop_id) AS n_stop_ids, COUNT(*) AS stop_events
      FROM star GROUP BY station_id) g
LEFT JOIN stops s ON s.stop_id = g.station_id
LEFT JOIN translations tr ON tr.table_name = 'stops' AND tr.field_name = 'stop_name'
      AND tr.field_value = s.stop_name AND tr.language = 'en'""")
def canonical_station(spark, d):
    return P.canonical_station(_parts(spark, d, ("stop_id",)), X.stops(spark, d),
                               X.translations(spark, d))


@register("station_aliases", sql_with("alias_stops", "translations").replace("WITH ", "WITH RECURSIVE ", 1) + """,
spelt AS (SELECT stop_id, lower(trim(unnest(string_split(stop_name, '/')))) AS name FROM alias_stops),
pairs AS (SELECT lower(field_value) AS a, lower(translation) AS b FROM translations
          UNION SELECT lower(translation), lower(field_value) FROM translations
          UNION SELECT x.name, y.name FROM spelt x JOIN spelt y ON x.stop_id = y.stop_id),
reach AS (SELECT DISTINCT name, name AS other FROM spelt UNION SELECT r.name, p.b FROM reach r JOIN pairs p ON p.a = r.other)
SELECT s.stop_id, MIN(o.stop_id) AS canonical_id
FROM spelt s JOIN reach r ON r.name = s.name JOIN spelt o ON o.name = r.other GROUP BY s.stop_id""")
def station_aliases(spark, d):
    from tramline.operators.aliases import station_aliases as aliases
    return aliases(X.alias_stops(spark, d), X.translations(spark, d))


# ---------------------------------------------------------------- W-3, J-7
@register("latest_update_flag", sql_with("fact_trip_updates") + """
SELECT update_pk, trip_id, update_timestamp,
       update_timestamp = MAX(update_timestamp) OVER (PARTITION BY trip_id) AS is_latest
FROM fact_trip_updates""")
def latest_update_flag(spark, d):
    return P.with_latest_flag(X.fact_trip_updates(spark, d)).select(
        "update_pk", "trip_id", "update_timestamp", "is_latest")


@register("latest_per_trip", """
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
                               ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC) AS rn
  FROM events) WHERE rn = 1""")
def latest_per_trip(spark, d):
    """STR-3 batch twin on events: the newest event per user (no ts ties)."""
    from tramline.sources.tables import read_table
    e = read_table(spark, d, "events", "user_id", "ts", "event_id", "event_type", "value")
    return P.latest_per_key(e, "user_id", "ts", ["event_id", "event_type", "value"])


@register("left_join_stations", sql_with("fact_stop_updates", "stops") + """
SELECT s.stop_name, s.platform_code, COUNT(*) AS stop_events
FROM fact_stop_updates f LEFT JOIN stops s ON f.stop_id = s.stop_id
GROUP BY s.stop_name, s.platform_code""")
def left_join_stations_q(spark, d):
    # count events per stop first; the soft-reference join then sees one row per stop
    per_stop = X.fact_stop_updates(spark, d).groupBy("stop_id").agg(F.count(F.lit(1)).alias("_n"))
    j = left_join_stations(per_stop, X.stops(spark, d))
    return j.groupBy("stop_name", "platform_code").agg(
        F.sum("_n").cast("bigint").alias("stop_events"))
