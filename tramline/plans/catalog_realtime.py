"""Checked queries: GTFS-RT flattening (SRC-3, F-6, F-8, F-9, JSN-*, KEY-*, SNK-6).

The Spark side builds poll payloads (JSON text) from orders / lineitem /
conversations, parses them back with the declared feed schema and
flattens them. The SQL side computes the same rows straight from the flat
tables, so the check covers JSON parsing, 64-bit decoding, explode and
filtering. Surrogate key *values* are not compared, only their counts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions.timecols import decode_long, epoch_to_ts
from tramline.operators import realtime as R
from tramline.operators.joins import parent_child
from tramline.plans.catalog import register
from tramline.sources import standins as X

STATION_TEXT = "Supplier#00000001"  # F-8 name fragment (matches 10 suppliers)
_ENTITY_ID = {"entity_id": "entity.id"}


def _trip_polls(spark, d):
    """The trip-update polls derived from orders/lineitem, built and parsed in one lazy plan."""
    return R.parse_polls(X.trip_feed_polls(spark, d))


def _alert_polls(spark, d):
    return R.parse_polls(X.alert_feed_polls(spark, d))


def _trip_ents(spark, d):
    return R.entities(_trip_polls(spark, d))


def _alert_ents(spark, d):
    return R.alert_entities(R.entities(_alert_polls(spark, d)))


def _kept(spark, d, station=STATION_TEXT):
    """The kept entities with their id and stops alone: no more of them is shuffled to meet the filter's keys."""
    ents = R.trip_update_entities(_trip_ents(spark, d))
    stops = F.struct(F.col("entity.tripUpdate.stopTimeUpdate").alias("stopTimeUpdate"))
    ents = ents.withColumn("entity", F.struct(F.col("entity.id").alias("id"), stops.alias("tripUpdate")))
    ids = R.resolve_station_ids(X.rt_stations(spark, d), station)
    return R.filter_trips_by_stations(ents, ids)


_POLL_TS = ("TIMESTAMP '2024-01-01 00:00:00' + "
            "to_minutes(CAST(floor({k} / 64) * 10 AS INTEGER))")
_TS = "make_timestamp(CAST({e} AS BIGINT) * 1000000)"
_ORDER_EPOCH = "(CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400)"
_ARR_EPOCH = "(CAST(epoch(l_shipdate) AS BIGINT) + (l_partkey % 24) * 3600)"
_DELAY = "CAST((l_partkey * 7 + l_suppkey * 13) % 600 - 60 AS INTEGER)"
_MATCH_IDS = f"SELECT s_suppkey FROM supplier WHERE s_name ILIKE '%{STATION_TEXT}%'"


# ------------------------------------------------------------ trip feed
@register("rt_entity_scan", f"""
SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS entity_id, COALESCE(n, 0) AS n_stops
FROM orders LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey) li
  ON o_orderkey = l_orderkey""")
def rt_entity_scan(spark, d):
    e = _trip_ents(spark, d)
    return e.select(F.col("entity.id").alias("entity_id"),
                    F.coalesce(F.size("entity.tripUpdate.stopTimeUpdate"), F.lit(0)
                               ).cast("bigint").alias("n_stops"))


@register("rt_entity_kind", """
SELECT 'trip_update' AS kind, COUNT(*) AS n FROM orders
UNION ALL
SELECT 'alert', COUNT(DISTINCT conv_id) FROM conversations""")
def rt_entity_kind(spark, d):
    t = R.entities(_trip_polls(spark, d))
    a = R.entities(_alert_polls(spark, d))
    return (R.entity_kind(t.unionByName(a)).groupBy("kind")
            .agg(F.count(F.lit(1)).alias("n")))


@register("rt_trip_updates", f"""
SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS entity_id,
       CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id,
       strftime(o_orderdate, '%Y%m%d') AS start_date,
       lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00' AS start_time,
       CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS trip_schedule_relationship,
       'v' || CAST(o_orderkey % 997 AS VARCHAR) AS vehicle_id,
       CAST(o_custkey AS VARCHAR) AS vehicle_label,
       'B-' || CAST(o_orderkey % 1000 AS VARCHAR) AS license_plate,
       CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 300 AS INTEGER) END AS overall_delay,
       {_TS.format(e=_ORDER_EPOCH)} AS update_timestamp,
       {_POLL_TS.format(k='o_orderkey')} AS fetched_at
FROM orders""")
def rt_trip_updates(spark, d):
    ents = R.trip_update_entities(_trip_ents(spark, d))
    return R.trip_updates(ents).drop("update_pk", "feed", "source_file")


@register("rt_trip_stop_updates", f"""
SELECT 'T' || CAST(l_orderkey AS VARCHAR) AS entity_id,
       CASE WHEN l_suppkey % 11 <> 0 THEN l_linenumber ELSE 0 END AS stop_sequence,
       's' || CAST(l_suppkey AS VARCHAR) AS stop_id,
       {_TS.format(e=_ARR_EPOCH)} AS arrival_time,
       CASE WHEN l_partkey % 5 <> 0 THEN {_DELAY} END AS arrival_delay,
       {_TS.format(e=_ARR_EPOCH + ' + 60')} AS departure_time,
       {_DELAY} AS departure_delay,
       0 AS schedule_relationship
FROM lineitem""")
def rt_trip_stop_updates(spark, d):
    ents = R.trip_update_entities(_trip_ents(spark, d))
    return R.trip_stop_updates(ents, carry=_ENTITY_ID).drop("update_pk", "id")


@register("decode_long", f"""
SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS entity_id, {_ORDER_EPOCH} AS timestamp_value
FROM orders""")
def decode_long_q(spark, d):
    e = _trip_ents(spark, d)
    return e.select(F.col("entity.id").alias("entity_id"),
                    decode_long(F.col("entity.tripUpdate.timestamp")).alias("timestamp_value"))


@register("epoch_to_ts", f"""
SELECT 'T' || CAST(l_orderkey AS VARCHAR) AS entity_id,
       's' || CAST(l_suppkey AS VARCHAR) AS stop_id,
       {_ARR_EPOCH} + 60 AS departure_epoch,
       {_TS.format(e=_ARR_EPOCH + ' + 60')} AS departure_time
FROM lineitem""")
def epoch_to_ts_q(spark, d):
    e = _trip_ents(spark, d)
    s = e.select(F.col("entity.id").alias("entity_id"),
                 F.explode("entity.tripUpdate.stopTimeUpdate").alias("s"))
    return s.select("entity_id", F.col("s.stopId").alias("stop_id"),
                    decode_long(F.col("s.departure.time")).alias("departure_epoch"),
                    epoch_to_ts(F.col("s.departure.time")).alias("departure_time"))


# ------------------------------------------------------- station filter
@register("resolve_stations", f"""
SELECT 's' || CAST(s_suppkey AS VARCHAR) AS stop_id
FROM supplier WHERE s_name ILIKE '%{STATION_TEXT}%'""")
def resolve_stations(spark, d):
    return R.resolve_station_ids(X.rt_stations(spark, d), STATION_TEXT)


@register("rt_station_filter", f"""
SELECT 'T' || CAST(l_orderkey AS VARCHAR) AS entity_id,
       CASE WHEN l_suppkey % 11 <> 0 THEN l_linenumber ELSE 0 END AS stop_sequence,
       's' || CAST(l_suppkey AS VARCHAR) AS stop_id
FROM lineitem
WHERE NOT EXISTS ({_MATCH_IDS})  -- T-1: no matching station means no filter
   OR l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_suppkey IN ({_MATCH_IDS}))""")
def rt_station_filter(spark, d):
    return (R.trip_stop_updates(_kept(spark, d), carry=_ENTITY_ID)
            .select("entity_id", "stop_sequence", "stop_id"))


@register("rt_station_filter_most", """
SELECT 'T' || CAST(l_orderkey AS VARCHAR) AS entity_id, COUNT(*) AS n_stops
FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_name ILIKE '%r#0%')
GROUP BY l_orderkey""")
def rt_station_filter_most(spark, d):
    """A text that most station names have: the ids are as many as the stations."""
    return (R.trip_stop_updates(_kept(spark, d, "R#0"), carry=_ENTITY_ID)
            .groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_stops")))


@register("rt_ingest_summary", f"""
SELECT '{STATION_TEXT}' AS station_filter, 'ok' AS status,
       (SELECT COUNT(*) FROM supplier WHERE s_name ILIKE '%{STATION_TEXT}%')
         AS resolved_stop_ids_count,
       (SELECT COUNT(*) FROM orders) AS total_trips_fetched,
       CASE WHEN NOT EXISTS ({_MATCH_IDS}) THEN (SELECT COUNT(*) FROM orders)
            ELSE (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem
                  WHERE l_suppkey IN ({_MATCH_IDS})) END AS trips_inserted,
       (SELECT COUNT(DISTINCT conv_id) FROM conversations) AS alerts_processed""")
def rt_ingest_summary(spark, d):
    out = R.flatten(_trip_polls(spark, d), _alert_polls(spark, d),
                    X.rt_stations(spark, d), STATION_TEXT)
    return out["summary"]


@register("parent_child_join", """
SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id,
       CASE WHEN l_suppkey % 11 <> 0 THEN l_linenumber ELSE 0 END AS stop_sequence,
       's' || CAST(l_suppkey AS VARCHAR) AS stop_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def parent_child_join(spark, d):
    ents = R.trip_update_entities(_trip_ents(spark, d))
    heads = R.trip_updates(ents).select("update_pk", "trip_id", "route_id")
    return (parent_child(heads, R.trip_stop_updates(ents), "update_pk")
            .select("trip_id", "route_id", "stop_sequence", "stop_id"))


@register("surrogate_keys", """
SELECT (SELECT COUNT(*) FROM orders) AS trip_updates,
       (SELECT COUNT(*) FROM orders) AS distinct_update_pk,
       (SELECT COUNT(*) FROM lineitem) AS stop_updates,
       (SELECT COUNT(*) FROM lineitem) AS distinct_stop_ids,
       CAST(0 AS BIGINT) AS orphan_stop_updates,
       (SELECT COUNT(DISTINCT conv_id) FROM conversations) AS alerts,
       (SELECT COUNT(*) FROM conversations WHERE role IN ('user', 'assistant', 'system'))
         AS alert_texts,
       (SELECT COUNT(*) FROM conversations WHERE role IN ('user', 'assistant', 'system'))
         AS distinct_text_ids""")
def surrogate_keys(spark, d):
    """KEY-1/KEY-2: key counts — unique parents, unique children, no orphans.

    Parent keys and child rows are unioned and checked with one aggregate per
    ``update_pk``: uniqueness of both and orphans in a single shuffle, no
    anti-join. A child's id begins with its ``update_pk``, so that ids can
    only be equal within one, and their distinct counts per key add up.
    """
    ents = R.trip_update_entities(_trip_ents(spark, d))
    tu = R.trip_updates(ents).select("update_pk", F.lit(None).cast("string").alias("id"),
                                     F.lit(1).alias("is_parent"))
    st = R.trip_stop_updates(ents).select("update_pk", "id", F.lit(0).alias("is_parent"))
    per_key = tu.unionByName(st).repartition("update_pk").groupBy("update_pk").agg(
        F.sum("is_parent").alias("parents"),
        F.count("id").alias("children"),
        F.count_distinct("id").alias("ids"))
    trip = per_key.agg(
        F.sum("parents").cast("bigint").alias("trip_updates"),
        F.count_if(F.col("parents") > 0).alias("distinct_update_pk"),
        F.sum("children").cast("bigint").alias("stop_updates"),
        F.sum(F.when(F.col("parents") == 0, F.col("children")).otherwise(0)
              ).cast("bigint").alias("orphan_stop_updates"),
        F.coalesce(F.sum("ids"), F.lit(0)).cast("bigint").alias("distinct_stop_ids"))
    a_ents = _alert_ents(spark, d)
    texts = R.alert_texts(a_ents).agg(
        F.count(F.lit(1)).alias("alert_texts"), F.count_distinct("id").alias("distinct_text_ids"))
    alerts = a_ents.agg(F.count(F.lit(1)).alias("alerts"))
    t = texts.select(F.struct(*texts.columns)).scalar()  # one row, read once for both columns
    return trip.select(*trip.columns, alerts.scalar().alias("alerts"), *[t[c].alias(c) for c in texts.columns])


# ------------------------------------------------------------ alert feed
_ALERT_ID = "'A' || CAST(conv_id AS VARCHAR)"
_PERIOD_BASE = "(1704067200 + conv_id * 86400 + turn * 600)"


@register("rt_service_alerts", f"""
SELECT {_ALERT_ID} AS entity_id, CAST(conv_id % 12 + 1 AS INTEGER) AS cause,
       CAST(conv_id % 10 + 1 AS INTEGER) AS effect,
       {_POLL_TS.format(k='conv_id')} AS fetched_at
FROM (SELECT DISTINCT conv_id FROM conversations)""")
def rt_service_alerts(spark, d):
    return R.service_alerts(_alert_ents(spark, d)).drop("alert_pk", "feed", "source_file")




@register("rt_alert_periods", f"""
SELECT {_ALERT_ID} AS entity_id, {_TS.format(e=_PERIOD_BASE)} AS period_start,
       {_TS.format(e=_PERIOD_BASE + ' + 600')} AS period_end
FROM conversations WHERE turn % 2 = 0""")
def rt_alert_periods(spark, d):
    return R.alert_active_periods(_alert_ents(spark, d), carry=_ENTITY_ID).drop("alert_pk", "id")


@register("rt_alert_texts", f"""
SELECT {_ALERT_ID} AS entity_id,
       CASE role WHEN 'user' THEN 'header' WHEN 'assistant' THEN 'description'
                 ELSE 'url' END AS field_name,
       CAST(turn AS VARCHAR) AS language, text AS text_value
FROM conversations WHERE role IN ('user', 'assistant', 'system')""")
def rt_alert_texts(spark, d):
    return R.alert_texts(_alert_ents(spark, d), carry=_ENTITY_ID).drop("alert_pk", "id")


@register("rt_alert_entities", f"""
SELECT {_ALERT_ID} AS entity_id, 'AG' || CAST(conv_id % 3 AS VARCHAR) AS agency_id,
       CAST(conv_id % 40 AS VARCHAR) AS route_id, 2 AS route_type,
       CAST(conv_id * 100 + turn AS VARCHAR) AS trip_id, '20240101' AS trip_start_date,
       lpad(CAST(turn AS VARCHAR), 2, '0') || ':00:00' AS trip_start_time,
       0 AS trip_schedule_relationship, 's' || CAST(turn AS VARCHAR) AS stop_id
FROM conversations""")
def rt_alert_entities(spark, d):
    return R.alert_informed_entities(_alert_ents(spark, d), carry=_ENTITY_ID).drop("alert_pk", "id")
