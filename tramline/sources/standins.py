"""Transit-shaped tables derived from the driver's TPC-H-like parquet.

The real inputs (a GTFS feed and GTFS-RT polls) are not available to the
test driver, so every query runs on tables *derived by Spark* from the
driver's tables; their size grows with the scale factor. Each builder has a
DuckDB SQL twin in ``SQL`` so the oracle computes the same inputs.

Mapping (driver -> transit):
  customer -> routes          orders   -> trips, trip_updates
  lineitem -> stop_times,     supplier -> platforms (stops with a parent)
              trip_stop_updates
  nation   -> stations, translations, star dim_routes
  events   -> calendar_dates  conversations -> service alerts
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.sources.tables import read_table

# Fixed parameters of the derivation (documented in FIXTURES.md §4).
STAR_DELAY_NULL_MOD = 5          # arrival_delay NULL when l_partkey % 5 = 0
POLL_SIZE = 64                   # entities per stand-in poll file (bounded)
POLL_EPOCH = "2024-01-01 00:00:00"
POLL_INTERVAL_MIN = 10


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _lit(v) -> Column:
    return F.lit(v)


# ------------------------------------------------------------------ schedule
def routes(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
    prefix = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", _lit("IC-"))
              .when(F.col("c_mktsegment") == "BUILDING", _lit("S"))
              .when(F.col("c_mktsegment") == "FURNITURE", _lit("L"))
              .otherwise(_lit("P")))
    return c.select(
        _s("c_custkey").alias("route_id"),
        F.concat(prefix, _s(F.col("c_custkey") % 40)).alias("route_short_name"),
        F.col("c_name").alias("route_long_name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 3).otherwise(2).alias("route_type"),
    )


def trips(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_orderpriority")
    return o.select(
        _s("o_orderkey").alias("trip_id"),
        _s("o_custkey").alias("route_id"),
        _s("o_custkey").alias("service_id"),
        F.col("o_orderpriority").alias("trip_headsign"),
        F.when(F.col("o_orderstatus") == "F", 1)
         .when(F.col("o_orderstatus") == "O", 2).alias("bikes_allowed"),
        F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(0).alias("wheelchair_accessible"),
    )


def _hms(h: Column, m: Column) -> Column:
    return F.concat(F.lpad(_s(h), 2, "0"), _lit(":"), F.lpad(_s(m), 2, "0"), _lit(":00"))


def stop_times(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber")
    t = _hms(F.col("l_partkey") % 27, F.col("l_orderkey") % 60)
    return li.select(
        _s("l_orderkey").alias("trip_id"),
        t.alias("arrival_time"),
        t.alias("departure_time"),
        F.concat(_lit("s"), _s("l_suppkey")).alias("stop_id"),
        F.col("l_linenumber").alias("stop_sequence"),
    )


def stops(spark: SparkSession, d: str) -> DataFrame:
    """Stations (one per nation) and platforms (one per supplier)."""
    n = read_table(spark, d, "nation", "n_nationkey", "n_name")
    s = read_table(spark, d, "supplier", "s_suppkey", "s_nationkey")
    stations = n.select(
        F.concat(_lit("n"), _s("n_nationkey")).alias("stop_id"),
        F.col("n_name").alias("stop_name"),
        _lit(None).cast("string").alias("parent_station"),
        _lit(None).cast("string").alias("platform_code"),
        _lit(1).alias("location_type"),
    )
    # nation has 25 rows by definition of the schema: a proven size bound.
    platforms = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select(
        F.concat(_lit("s"), _s("s_suppkey")).alias("stop_id"),
        F.col("n_name").alias("stop_name"),
        F.concat(_lit("n"), _s("s_nationkey")).alias("parent_station"),
        F.when(F.col("s_suppkey") % 7 != 0, _s(F.col("s_suppkey") % 7)).alias("platform_code"),
        _lit(0).alias("location_type"),
    )
    return stations.unionByName(platforms)


def calendar_dates(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events", "user_id", "event_type", "ts")
    sid = F.when(F.col("user_id") % 2 == 0, F.concat(_s("user_id"), _lit("-all"))) \
           .otherwise(F.concat(_s("user_id"), _lit("-"), F.col("event_type")))
    # an error removes the date (2), any other event adds it (1)
    return e.select(sid.alias("service_id"), F.date_format("ts", "yyyyMMdd").alias("date"),
                    F.when(F.col("event_type") == "error", 2).otherwise(1).alias("exception_type")).distinct()


def translations(spark: SparkSession, d: str) -> DataFrame:
    n = read_table(spark, d, "nation", "n_nationkey", "n_name")
    return n.filter(F.col("n_nationkey") % 2 == 0).select(
        _lit("stops").alias("table_name"), _lit("stop_name").alias("field_name"),
        F.col("n_name").alias("field_value"), _lit("en").alias("language"),
        F.concat(_lit("EN "), F.col("n_name")).alias("translation"),
    )


def alias_stops(spark: SparkSession, d: str) -> DataFrame:
    """Stations (one per supplier) that spell their nation's name in one of four ways, one of them twofold."""
    n = read_table(spark, d, "nation", "n_nationkey", "n_name")
    s = read_table(spark, d, "supplier", "s_suppkey", "s_nationkey")
    kind, name = F.col("s_suppkey") % 4, F.col("n_name")
    spelt = (F.when(kind == 0, name).when(kind == 1, F.concat(_lit("EN "), name))
             .when(kind == 2, F.concat(name, _lit(" / FR "), name)).otherwise(F.concat(_lit("FR "), name)))
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.concat(_lit("s"), _s("s_suppkey")).alias("stop_id"), spelt.alias("stop_name"))


# ---------------------------------------------------------- punctuality star
def fact_trip_updates(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return o.select(F.col("o_orderkey").alias("update_pk"),
                    _s("o_custkey").alias("trip_id"),
                    F.col("o_orderdate").alias("update_timestamp"))


def fact_stop_updates(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_shipdate")
    delay = ((F.col("l_partkey") * 7 + F.col("l_suppkey") * 13) % 600 - 60).cast("int")
    return li.select(
        F.col("l_orderkey").alias("update_pk"),
        F.col("l_linenumber").alias("stop_sequence"),
        F.concat(_lit("s"), _s("l_suppkey")).alias("stop_id"),
        F.timestamp_add("HOUR", F.col("l_partkey") % 24, F.col("l_shipdate")).alias("arrival_time"),
        F.when(F.col("l_partkey") % STAR_DELAY_NULL_MOD != 0, delay).alias("arrival_delay"),
    )


def star_dim_trips(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer", "c_custkey", "c_nationkey")
    return c.select(_s("c_custkey").alias("trip_id"), _s("c_nationkey").alias("route_id"))


def star_dim_routes(spark: SparkSession, d: str) -> DataFrame:
    n = read_table(spark, d, "nation", "n_nationkey", "n_regionkey")
    m = F.col("n_nationkey") % 4
    prefix = (F.when(m == 0, _lit("IC-")).when(m == 1, _lit("S"))
              .when(m == 2, _lit("L")).otherwise(_lit("P")))
    return n.select(
        _s("n_nationkey").alias("route_id"),
        F.concat(prefix, _s("n_nationkey")).alias("route_short_name"),
        F.when(F.col("n_regionkey") == 4, 3).otherwise(2).alias("route_type"),
    )


def rt_stations(spark: SparkSession, d: str) -> DataFrame:
    """dim_stations for the real-time filter: one stop per supplier, named s_name."""
    s = read_table(spark, d, "supplier", "s_suppkey", "s_name")
    return s.select(F.concat(_lit("s"), _s("s_suppkey")).alias("stop_id"),
                    F.col("s_name").alias("stop_name"))


# ------------------------------------------------------ GTFS-RT poll payloads
def _long_object(v: Column) -> Column:
    """A BIGINT as the protobuf Long object {low, high, unsigned}."""
    low32 = v.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    low = F.when(low32 >= F.lit(2 ** 31), low32 - F.lit(2 ** 32)).otherwise(low32)
    return F.struct(low.cast("int").alias("low"),
                    F.shiftright(v, 32).cast("int").alias("high"),
                    F.lit(False).alias("unsigned"))


def _unix(ts: str) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def _polls(entities: DataFrame, feed: str) -> DataFrame:
    """Pack entity JSON texts into poll payloads of at most POLL_SIZE entities.

    Entity order inside a poll is fixed by the ordering key, so positions
    (and the surrogate keys built on them) are reproducible. Each payload
    carries ``header.timestamp`` = the poll time (epoch seconds).
    """
    grouped = (entities.groupBy("poll_id")
               .agg(F.array_sort(F.collect_list(F.struct("k", "entity_json"))).alias("ents")))
    fetched = F.timestamp_add("MINUTE", F.col("poll_id") * POLL_INTERVAL_MIN,
                              F.lit(POLL_EPOCH).cast("timestamp_ntz"))
    header = F.to_json(F.struct(F.lit("2.0").alias("gtfsRealtimeVersion"),
                                F.unix_seconds(fetched.cast("timestamp")).alias("timestamp")))
    return grouped.select(
        F.lit(feed).alias("feed"),
        F.format_string(f"{feed}/poll-%08d.json", F.col("poll_id")).alias("source_file"),
        fetched.alias("fetched_at"),
        F.concat(F.lit('{"header":'), header, F.lit(',"entity":['),
                 F.array_join(F.transform("ents", lambda e: e["entity_json"]), ","),
                 F.lit("]}")).alias("payload"),
    )


def trip_feed_polls(spark: SparkSession, d: str) -> DataFrame:
    """Trip-update poll payloads: one entity per order, its lines as stops.

    Odd orders send ``timestamp`` as a Long object, even ones as a number;
    departure times are always objects; stopSequence is absent when
    ``l_suppkey % 11 = 0``. Orders without lines have a header and no stops.
    """
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_shipdate")
    arr = _unix("l_shipdate") + (F.col("l_partkey") % 24) * 3600
    delay = ((F.col("l_partkey") * 7 + F.col("l_suppkey") * 13) % 600 - 60).cast("int")
    stop = F.struct(
        F.when(F.col("l_suppkey") % 11 != 0, F.col("l_linenumber")).alias("stopSequence"),
        F.concat(_lit("s"), _s("l_suppkey")).alias("stopId"),
        _lit(0).alias("scheduleRelationship"),
        F.struct(arr.alias("time"),
                 F.when(F.col("l_partkey") % STAR_DELAY_NULL_MOD != 0, delay).alias("delay")
                 ).alias("arrival"),
        F.struct(_long_object(arr + 60).alias("time"), delay.alias("delay")).alias("departure"),
    )
    # Hash-partition on the grouping key first: the groupBy and the join
    # below reuse this partitioning (no extra shuffle), and the per-row JSON
    # work runs after the shuffle, spread over all tasks.
    stops_per_order = (li.repartition("l_orderkey").groupBy("l_orderkey")
                       .agg(F.array_sort(F.collect_list(
                           F.struct(F.col("l_linenumber").alias("_o1"),
                                    F.col("l_suppkey").alias("_o2"),
                                    F.col("l_partkey").alias("_o3"), stop.alias("s")))
                       ).alias("stops")))
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate",
                   "o_orderstatus").repartition("o_orderkey")
    # Both sides are already hash-partitioned on the order key: a merge join
    # needs no exchange (AQE would otherwise broadcast the stop arrays).
    e = o.join(stops_per_order.hint("merge"), o.o_orderkey == stops_per_order.l_orderkey,
               "left")
    ts = _unix("o_orderdate") + F.col("o_orderkey") % 86400
    stu = F.transform("stops", lambda x: x["s"])
    common = [
        F.struct(_s("o_orderkey").alias("tripId"), _s("o_custkey").alias("routeId"),
                 F.date_format("o_orderdate", "yyyyMMdd").alias("startDate"),
                 F.format_string("%02d:00:00", (F.col("o_orderkey") % 24).cast("int")
                                 ).alias("startTime"),
                 F.when(F.col("o_orderstatus") == "P", 1).otherwise(0
                        ).alias("scheduleRelationship")).alias("trip"),
        F.struct(F.concat(_lit("v"), _s(F.col("o_orderkey") % 997)).alias("id"),
                 _s("o_custkey").alias("label"),
                 F.concat(_lit("B-"), _s(F.col("o_orderkey") % 1000)).alias("licensePlate")
                 ).alias("vehicle"),
        F.when(F.col("o_orderkey") % 4 != 0, (F.col("o_orderkey") % 300).cast("int")
               ).alias("delay"),
    ]
    as_number = F.struct(*common, ts.alias("timestamp"), stu.alias("stopTimeUpdate"))
    as_object = F.struct(*common, _long_object(ts).alias("timestamp"),
                         stu.alias("stopTimeUpdate"))
    entity_id = F.concat(_lit("T"), _s("o_orderkey"))
    ent_json = F.when(
        F.col("o_orderkey") % 2 == 0,
        F.to_json(F.struct(entity_id.alias("id"), as_number.alias("tripUpdate"))),
    ).otherwise(F.to_json(F.struct(entity_id.alias("id"), as_object.alias("tripUpdate"))))
    ents = e.select(F.floor(F.col("o_orderkey") / POLL_SIZE).alias("poll_id"),
                    F.col("o_orderkey").alias("k"), ent_json.alias("entity_json"))
    return _polls(ents, "trip-update")


def alert_feed_polls(spark: SparkSession, d: str) -> DataFrame:
    """Alert poll payloads: one alert per conversation.

    user turns -> headerText, assistant -> descriptionText, system -> url,
    language = the turn number; every turn names an informed entity; even
    turns open an active period (start as a number, end as a Long object).
    """
    cv = read_table(spark, d, "conversations", "conv_id", "turn", "role", "text")
    per = cv.repartition("conv_id").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def texts(role):
        return F.struct(F.transform(
            F.filter("turns", lambda t: t["role"] == role),
            lambda t: F.struct(_s(t["turn"]).alias("language"), t["text"].alias("text")),
        ).alias("translation"))

    base = F.lit(1704067200) + F.col("conv_id") * 86400
    periods = F.transform(
        F.filter("turns", lambda t: t["turn"] % 2 == 0),
        lambda t: F.struct((base + t["turn"] * 600).alias("start"),
                           _long_object(base + t["turn"] * 600 + 600).alias("end")),
    )
    informed = F.transform("turns", lambda t: F.struct(
        F.concat(_lit("AG"), _s(F.col("conv_id") % 3)).alias("agencyId"),
        _s(F.col("conv_id") % 40).alias("routeId"),
        _lit(2).alias("routeType"),
        F.concat(_lit("s"), _s(t["turn"])).alias("stopId"),
        F.struct(_s(F.col("conv_id") * 100 + t["turn"]).alias("tripId"),
                 _lit("20240101").alias("startDate"),
                 F.format_string("%02d:00:00", t["turn"].cast("int")).alias("startTime"),
                 _lit(0).alias("scheduleRelationship")).alias("trip"),
    ))
    alert = F.struct(
        (F.col("conv_id") % 12 + 1).cast("int").alias("cause"),
        (F.col("conv_id") % 10 + 1).cast("int").alias("effect"),
        periods.alias("activePeriod"),
        texts("user").alias("headerText"),
        texts("assistant").alias("descriptionText"),
        texts("system").alias("url"),
        informed.alias("informedEntity"),
    )
    ents = per.select(
        F.floor(F.col("conv_id") / POLL_SIZE).alias("poll_id"),
        F.col("conv_id").alias("k"),
        F.to_json(F.struct(F.concat(_lit("A"), _s("conv_id")).alias("id"),
                           alert.alias("alert"))).alias("entity_json"))
    return _polls(ents, "alert")


# ============================================================ DuckDB twins
# The same derivations in DuckDB SQL, used only by the oracle check.
SQL: dict[str, str] = {
    "routes": """
SELECT CAST(c_custkey AS VARCHAR) AS route_id,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'IC-' WHEN 'BUILDING' THEN 'S'
            WHEN 'FURNITURE' THEN 'L' ELSE 'P' END || CAST(c_custkey % 40 AS VARCHAR)
         AS route_short_name,
       c_name AS route_long_name,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 3 ELSE 2 END AS route_type
FROM customer""",
    "trips": """
SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id,
       CAST(o_custkey AS VARCHAR) AS service_id, o_orderpriority AS trip_headsign,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS bikes_allowed,
       CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS wheelchair_accessible
FROM orders""",
    "stop_times": """
SELECT CAST(l_orderkey AS VARCHAR) AS trip_id,
       lpad(CAST(l_partkey % 27 AS VARCHAR), 2, '0') || ':' ||
         lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') || ':00' AS arrival_time,
       lpad(CAST(l_partkey % 27 AS VARCHAR), 2, '0') || ':' ||
         lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') || ':00' AS departure_time,
       's' || CAST(l_suppkey AS VARCHAR) AS stop_id,
       l_linenumber AS stop_sequence
FROM lineitem""",
    "stops": """
SELECT 'n' || CAST(n_nationkey AS VARCHAR) AS stop_id, n_name AS stop_name,
       CAST(NULL AS VARCHAR) AS parent_station, CAST(NULL AS VARCHAR) AS platform_code,
       1 AS location_type
FROM nation
UNION ALL
SELECT 's' || CAST(s_suppkey AS VARCHAR), n_name, 'n' || CAST(s_nationkey AS VARCHAR),
       CASE WHEN s_suppkey % 7 <> 0 THEN CAST(s_suppkey % 7 AS VARCHAR) END, 0
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "calendar_dates": """
SELECT DISTINCT
       CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) || '-all'
            ELSE CAST(user_id AS VARCHAR) || '-' || event_type END AS service_id,
       strftime(ts, '%Y%m%d') AS date, CASE event_type WHEN 'error' THEN 2 ELSE 1 END AS exception_type
FROM events""",
    "translations": """
SELECT 'stops' AS table_name, 'stop_name' AS field_name, n_name AS field_value,
       'en' AS language, 'EN ' || n_name AS translation
FROM nation WHERE n_nationkey % 2 = 0""",
    "alias_stops": """
SELECT 's' || CAST(s_suppkey AS VARCHAR) AS stop_id,
       CASE s_suppkey % 4 WHEN 0 THEN n_name WHEN 1 THEN 'EN ' || n_name
            WHEN 2 THEN n_name || ' / FR ' || n_name ELSE 'FR ' || n_name END AS stop_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "fact_trip_updates": """
SELECT o_orderkey AS update_pk, CAST(o_custkey AS VARCHAR) AS trip_id,
       o_orderdate AS update_timestamp
FROM orders""",
    "fact_stop_updates": """
SELECT l_orderkey AS update_pk, l_linenumber AS stop_sequence,
       's' || CAST(l_suppkey AS VARCHAR) AS stop_id,
       l_shipdate + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS arrival_time,
       CASE WHEN l_partkey % 5 <> 0
            THEN CAST((l_partkey * 7 + l_suppkey * 13) % 600 - 60 AS INTEGER) END
         AS arrival_delay
FROM lineitem""",
    "star_dim_trips": """
SELECT CAST(c_custkey AS VARCHAR) AS trip_id, CAST(c_nationkey AS VARCHAR) AS route_id
FROM customer""",
    "star_dim_routes": """
SELECT CAST(n_nationkey AS VARCHAR) AS route_id,
       CASE n_nationkey % 4 WHEN 0 THEN 'IC-' WHEN 1 THEN 'S' WHEN 2 THEN 'L' ELSE 'P' END
         || CAST(n_nationkey AS VARCHAR) AS route_short_name,
       CASE WHEN n_regionkey = 4 THEN 3 ELSE 2 END AS route_type
FROM nation""",
    "rt_stations": """
SELECT 's' || CAST(s_suppkey AS VARCHAR) AS stop_id, s_name AS stop_name FROM supplier""",
}


def sql_with(*names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH name AS (...), ...`` for the named stand-ins (plus extra CTEs)."""
    parts = [f"{n} AS ({SQL[n].strip()})" for n in names]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v.strip()})")
    return "WITH " + ",\n".join(parts) + "\n"


# ======================================================= raw text stand-ins
# All-string tables with padding, blanks and bad values added by rule, for
# the cleaning, dimension and integrity checks.
TAB = "\t"


def raw_stops_text(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier", "s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    sid = F.concat(_lit("s"), _s(k))
    return s.select(
        F.when(k % 3 == 0, F.concat(_lit(TAB + " "), sid, _lit("  "))).otherwise(sid).alias("stop_id"),
        F.when(k % 5 == 0, _lit("   ")).otherwise(F.concat(_lit(" "), F.col("s_name"), _lit(" "))
                                                 ).alias("stop_name"),
        F.when(k % 4 == 0, _lit("")).otherwise(F.concat(_lit("n"), _s("s_nationkey"))
                                              ).alias("parent_station"),
        F.when(k % 7 == 0, _lit("")).otherwise(_s(k % 7)).alias("platform_code"),
        F.when(k % 4 == 0, _lit("")).when(k % 4 == 1, _lit(" 1")).when(k % 4 == 2, _lit("2.0"))
         .otherwise(_lit("-1")).alias("wheelchair_boarding"),
    )


def _route_prefix(seg: Column) -> Column:
    return (F.when(seg == "AUTOMOBILE", _lit("IC-")).when(seg == "BUILDING", _lit("S"))
            .when(seg == "FURNITURE", _lit("L")).otherwise(_lit("P")))


def raw_routes_text(spark: SparkSession, d: str) -> DataFrame:
    """A route for every customer."""
    c = read_table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    k = F.col("c_custkey")
    return c.select(
        F.concat(_lit(" "), _s(k), _lit(" ")).alias("route_id"),
        F.when(k % 6 == 0, _lit("")).otherwise(F.concat(_lit("AG"), _s("c_nationkey"))
                                              ).alias("agency_id"),
        F.concat(_lit(TAB), _route_prefix(F.col("c_mktsegment")), _s(k % 40)).alias("route_short_name"),
        F.concat(F.col("c_name"), _lit(" -- "), F.repeat(_lit("x"), (k % 250).cast("int"))
                 ).alias("route_long_name"),
        F.when(k % 5 == 0, _lit("")).when(k % 5 == 1, _lit("0")).when(k % 5 == 2, _lit("3"))
         .when(k % 5 == 3, _lit(" 2 ")).otherwise(_lit("x")).alias("route_type"),
    )


def raw_routes_partial_text(spark: SparkSession, d: str) -> DataFrame:
    """The feed of the orphan checks: it lacks the routes of every tenth customer."""
    return raw_routes_text(spark, d).filter(F.trim("route_id").cast("bigint") % 10 != 0)


def raw_trips_text(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_orderpriority")
    k = F.col("o_orderkey")
    return o.select(
        F.when(k % 5 == 0, F.concat(_lit(" "), _s(k))).otherwise(_s(k)).alias("trip_id"),
        _s("o_custkey").alias("route_id"),
        F.when(k % 9 == 0, _lit(" ")).otherwise(_s("o_custkey")).alias("service_id"),
        F.concat(_lit(" "), F.col("o_orderpriority")).alias("trip_headsign"),
        F.when(F.col("o_orderstatus") == "F", _lit("1")).when(F.col("o_orderstatus") == "O", _lit("2"))
         .otherwise(_lit("")).alias("bikes_allowed"),
        F.when(k % 3 == 0, _lit("1")).otherwise(_lit("0")).alias("wheelchair_accessible"),
    )


def part_text(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size",
                   "p_retailprice")
    return p.select(
        _s("p_partkey").alias("p_partkey"), "p_name", "p_brand", "p_type",
        F.when(F.col("p_partkey") % 11 == 0, _lit("")).otherwise(_s("p_size")).alias("p_size"),
        _s("p_retailprice").alias("p_retailprice"),
        _lit("").alias("p_comment"),
        _lit(None).cast("string").alias("p_container"),
        _lit(" ").alias("p_mfgr"),
    )


def customer_text(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    k = F.col("c_custkey")
    nk = _s("c_nationkey")
    return c.select(
        "c_custkey",
        F.when(k % 4 == 0, _lit("")).when(k % 4 == 1, F.concat(_lit("  "), F.col("c_name")))
         .when(k % 4 == 2, F.concat(F.col("c_name"), _lit(TAB)))
         .otherwise(F.concat(_lit(TAB + " "), F.col("c_name"), _lit("  "))).alias("name_raw"),
        F.when(k % 5 == 0, F.concat(_lit("-"), nk)).when(k % 5 == 1, F.concat(_lit(" "), nk, _lit(" ")))
         .when(k % 5 == 2, _lit("")).when(k % 5 == 3, F.concat(nk, _lit(".5")))
         .otherwise(nk).alias("digits_raw"),
    )


def trip_updates_text(spark: SparkSession, d: str) -> DataFrame:
    """Header text columns with some values wider than their VARCHAR width."""
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate",
                   "o_orderpriority")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(_lit("T"), _s(k)).alias("entity_id"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("start_date"),
        F.when(k % 13 == 0, _lit("08:00:00.5")).otherwise(_lit("08:00:00")).alias("start_time"),
        F.concat(_lit("v"), _s(k)).alias("vehicle_id"),
        F.concat(_lit("PLATE-"), _s("o_custkey"), _lit("-"), F.col("o_orderpriority")
                 ).alias("license_plate"),
    )


def stop_updates_with_nulls(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("update_pk"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("stop_sequence"),
        F.when(F.col("l_suppkey") % 17 != 0, F.concat(_lit("s"), _s("l_suppkey"))).alias("stop_id"),
    )


def trips_partial(spark: SparkSession, d: str) -> DataFrame:
    """The parents of the foreign key checks lack some trips and stops (creates orphans)."""
    return trips(spark, d).filter(F.col("trip_id").cast("bigint") % 10 != 0)


def stops_partial(spark: SparkSession, d: str) -> DataFrame:
    return stops(spark, d).filter(~F.col("stop_id").endswith("7"))


def routes_partial(spark: SparkSession, d: str) -> DataFrame:
    """~routes without the customers where c_custkey % 10 = 0 (creates orphans)."""
    return routes(spark, d).filter(F.col("route_id").cast("bigint") % 10 != 0)


SQL.update({
    "raw_stops_text": """
SELECT CASE WHEN s_suppkey % 3 = 0 THEN chr(9) || ' s' || CAST(s_suppkey AS VARCHAR) || '  '
            ELSE 's' || CAST(s_suppkey AS VARCHAR) END AS stop_id,
       CASE WHEN s_suppkey % 5 = 0 THEN '   ' ELSE ' ' || s_name || ' ' END AS stop_name,
       CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'n' || CAST(s_nationkey AS VARCHAR) END
         AS parent_station,
       CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE CAST(s_suppkey % 7 AS VARCHAR) END AS platform_code,
       CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN ' 1' WHEN 2 THEN '2.0' ELSE '-1' END
         AS wheelchair_boarding
FROM supplier""",
    "raw_routes_text": """
SELECT ' ' || CAST(c_custkey AS VARCHAR) || ' ' AS route_id,
       CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'AG' || CAST(c_nationkey AS VARCHAR) END AS agency_id,
       chr(9) || CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'IC-' WHEN 'BUILDING' THEN 'S'
            WHEN 'FURNITURE' THEN 'L' ELSE 'P' END || CAST(c_custkey % 40 AS VARCHAR)
         AS route_short_name,
       c_name || ' -- ' || repeat('x', CAST(c_custkey % 250 AS INTEGER)) AS route_long_name,
       CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '3' WHEN 3 THEN ' 2 '
            ELSE 'x' END AS route_type
FROM customer""",
    "raw_trips_text": """
SELECT CASE WHEN o_orderkey % 5 = 0 THEN ' ' || CAST(o_orderkey AS VARCHAR)
            ELSE CAST(o_orderkey AS VARCHAR) END AS trip_id,
       CAST(o_custkey AS VARCHAR) AS route_id,
       CASE WHEN o_orderkey % 9 = 0 THEN ' ' ELSE CAST(o_custkey AS VARCHAR) END AS service_id,
       ' ' || o_orderpriority AS trip_headsign,
       CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '' END AS bikes_allowed,
       CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE '0' END AS wheelchair_accessible
FROM orders""",
    "part_text": """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
       CASE WHEN p_partkey % 11 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS p_size,
       p_retailprice AS p_retailprice_value,
       '' AS p_comment, CAST(NULL AS VARCHAR) AS p_container, ' ' AS p_mfgr
FROM part""",
    "customer_text": """
SELECT c_custkey,
       CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '  ' || c_name
            WHEN 2 THEN c_name || chr(9) ELSE chr(9) || ' ' || c_name || '  ' END AS name_raw,
       CASE c_custkey % 5 WHEN 0 THEN '-' || CAST(c_nationkey AS VARCHAR)
            WHEN 1 THEN ' ' || CAST(c_nationkey AS VARCHAR) || ' ' WHEN 2 THEN ''
            WHEN 3 THEN CAST(c_nationkey AS VARCHAR) || '.5'
            ELSE CAST(c_nationkey AS VARCHAR) END AS digits_raw
FROM customer""",
    "trip_updates_text": """
SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS entity_id, strftime(o_orderdate, '%Y%m%d') AS start_date,
       CASE WHEN o_orderkey % 13 = 0 THEN '08:00:00.5' ELSE '08:00:00' END AS start_time,
       'v' || CAST(o_orderkey AS VARCHAR) AS vehicle_id,
       'PLATE-' || CAST(o_custkey AS VARCHAR) || '-' || o_orderpriority AS license_plate
FROM orders""",
    "stop_updates_with_nulls": """
SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS update_pk,
       CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS stop_sequence,
       CASE WHEN l_suppkey % 17 <> 0 THEN 's' || CAST(l_suppkey AS VARCHAR) END AS stop_id
FROM lineitem""",
    "routes_partial": """
SELECT * FROM (""" + SQL["routes"] + """) WHERE CAST(route_id AS BIGINT) % 10 <> 0""",
})
SQL["trips_partial"] = f"""
SELECT * FROM ({SQL["trips"]}) WHERE CAST(trip_id AS BIGINT) % 10 <> 0"""
SQL["stops_partial"] = f"""
SELECT * FROM ({SQL["stops"]}) WHERE stop_id NOT LIKE '%7'"""
SQL["raw_routes_partial_text"] = f"""
SELECT * FROM ({SQL["raw_routes_text"]}) WHERE CAST(trim(route_id) AS BIGINT) % 10 <> 0"""
