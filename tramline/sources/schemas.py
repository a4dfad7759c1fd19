"""Declared schemas: GTFS static tables, the GTFS-RT JSON feed, the warehouse.

Static tables are declared as ordered ``(column, kind)`` pairs with kind
``str`` / ``int`` / ``float`` (what the files promise) plus their keys.
"""

from __future__ import annotations

from pyspark.sql import types as T

KIND_TO_SQL = {"str": "string", "int": "int", "float": "double"}

# The eight static tables, their columns in order and types.
GTFS_TABLES: dict[str, list[tuple[str, str]]] = {
    "routes": [("route_id", "str"), ("agency_id", "str"), ("route_short_name", "str"),
               ("route_long_name", "str"), ("route_type", "int"), ("route_color", "str"),
               ("route_text_color", "str")],
    "calendar": [("service_id", "str"), ("monday", "int"), ("tuesday", "int"),
                 ("wednesday", "int"), ("thursday", "int"), ("friday", "int"),
                 ("saturday", "int"), ("sunday", "int"), ("start_date", "str"),
                 ("end_date", "str")],
    "stops": [("stop_id", "str"), ("stop_name", "str"), ("stop_lat", "float"),
              ("stop_lon", "float"), ("location_type", "int"), ("parent_station", "str"),
              ("platform_code", "str"), ("stop_desc", "str")],
    "calendar_dates": [("service_id", "str"), ("date", "str"), ("exception_type", "int")],
    "trips": [("route_id", "str"), ("service_id", "str"), ("trip_id", "str"),
              ("trip_headsign", "str"), ("block_id", "str"), ("bikes_allowed", "int"),
              ("wheelchair_accessible", "int"), ("trip_short_name", "str")],
    "stop_times": [("trip_id", "str"), ("arrival_time", "str"), ("departure_time", "str"),
                   ("drop_off_type", "int"), ("pickup_type", "int"), ("stop_id", "str"),
                   ("stop_sequence", "int")],
    "transfers": [("from_stop_id", "str"), ("to_stop_id", "str"), ("transfer_type", "int"),
                  ("min_transfer_time", "int"), ("from_trip_id", "str"), ("to_trip_id", "str")],
    "translations": [("table_name", "str"), ("field_name", "str"), ("field_value", "str"),
                     ("language", "str"), ("translation", "str")],
}

# Load order: parents before children (drop order is the reverse).
GTFS_LOAD_ORDER = ["routes", "calendar", "stops", "calendar_dates", "trips",
                   "stop_times", "transfers", "translations"]

GTFS_PRIMARY_KEYS = {
    "routes": ["route_id"], "calendar": ["service_id"], "stops": ["stop_id"],
    "calendar_dates": ["service_id", "date"], "trips": ["trip_id"],
    "stop_times": ["trip_id", "stop_sequence"],
    "transfers": ["from_stop_id", "to_stop_id"],
    "translations": ["table_name", "field_name", "field_value", "language"],
}

GTFS_NOT_NULL = {
    "routes": ["route_id", "route_type"],
    "calendar": ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday",
                 "saturday", "sunday", "start_date", "end_date"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon", "location_type"],
    "calendar_dates": ["service_id", "date", "exception_type"],
    "trips": ["route_id", "service_id", "trip_id"],
    "stop_times": ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"],
    "transfers": ["from_stop_id", "to_stop_id", "transfer_type"],
    "translations": ["table_name", "field_name", "field_value", "language", "translation"],
}

# Fixed values: (child table, child column, parent table, parent column).
GTFS_FOREIGN_KEYS = [
    ("stops", "parent_station", "stops", "stop_id"),
    ("calendar_dates", "service_id", "calendar", "service_id"),
    ("trips", "route_id", "routes", "route_id"),
    ("trips", "service_id", "calendar", "service_id"),
    ("stop_times", "trip_id", "trips", "trip_id"),
    ("stop_times", "stop_id", "stops", "stop_id"),
    ("transfers", "from_stop_id", "stops", "stop_id"),
    ("transfers", "to_stop_id", "stops", "stop_id"),
]


# ---------------------------------------------------------------- GTFS-RT feed
# Field names and types of the feed.
# Every int64 that may arrive as {low, high, unsigned} is declared STRING:
# Spark then keeps the object's raw JSON text and decode_long() reads it.
_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()


def _f(name, dtype):
    return T.StructField(name, dtype, True)


TRIP_DESCRIPTOR = T.StructType([
    _f("tripId", _S), _f("routeId", _S), _f("startDate", _S), _f("startTime", _S),
    _f("scheduleRelationship", _I),
])
VEHICLE = T.StructType([_f("id", _S), _f("label", _S), _f("licensePlate", _S)])
STOP_EVENT = T.StructType([_f("time", _S), _f("delay", _I)])
STOP_TIME_UPDATE = T.StructType([
    _f("stopSequence", _I), _f("stopId", _S), _f("scheduleRelationship", _I),
    _f("arrival", STOP_EVENT), _f("departure", STOP_EVENT),
])
TRIP_UPDATE = T.StructType([
    _f("trip", TRIP_DESCRIPTOR), _f("vehicle", VEHICLE), _f("delay", _I),
    _f("timestamp", _S), _f("stopTimeUpdate", T.ArrayType(STOP_TIME_UPDATE)),
])
TRANSLATED = T.StructType([
    _f("translation", T.ArrayType(T.StructType([_f("language", _S), _f("text", _S)]))),
])
INFORMED_ENTITY = T.StructType([
    _f("agencyId", _S), _f("routeId", _S), _f("routeType", _I), _f("stopId", _S),
    _f("trip", TRIP_DESCRIPTOR),
])
ALERT = T.StructType([
    _f("cause", _I), _f("effect", _I),
    _f("activePeriod", T.ArrayType(T.StructType([_f("start", _S), _f("end", _S)]))),
    _f("headerText", TRANSLATED), _f("descriptionText", TRANSLATED), _f("url", TRANSLATED),
    _f("informedEntity", T.ArrayType(INFORMED_ENTITY)),
])
FEED_ENTITY = T.StructType([
    _f("id", _S), _f("tripUpdate", TRIP_UPDATE), _f("alert", ALERT),
])
FEED_MESSAGE = T.StructType([
    _f("header", T.StructType([_f("gtfsRealtimeVersion", _S), _f("timestamp", _S)])),
    _f("entity", T.ArrayType(FEED_ENTITY)),
])

# ------------------------------------------------------------ warehouse tables
# Column widths and NOT NULL columns of the warehouse tables.
# Column widths (characters) of the fact tables; dimension loaders truncate
# to the dimension widths instead of rejecting (CLN-3 vs CHK-5).
FACT_WIDTHS = {
    "trip_updates": {"entity_id": 100, "trip_id": 100, "route_id": 50, "start_date": 8,
                     "start_time": 8, "vehicle_id": 50, "vehicle_label": 50,
                     "license_plate": 20},
    "trip_stop_updates": {"stop_id": 50},
    "service_alerts": {"entity_id": 100},
    "alert_texts": {"field_name": 20, "language": 10},
    "alert_informed_entities": {"agency_id": 30, "route_id": 50, "trip_id": 100,
                                "trip_start_date": 8, "trip_start_time": 8, "stop_id": 50},
}
DIM_WIDTHS = {
    "dim_stations": {"stop_id": 50, "stop_name": 150, "parent_station": 50,
                     "platform_code": 20},
    "dim_routes": {"route_id": 50, "agency_id": 30, "route_short_name": 50,
                   "route_long_name": 200},
    "dim_trips": {"trip_id": 100, "route_id": 50, "service_id": 50, "trip_headsign": 150},
}
DIM_PRIMARY_KEYS = {"dim_stations": ["stop_id"], "dim_routes": ["route_id"], "dim_trips": ["trip_id"]}
WAREHOUSE_NOT_NULL = {
    "dim_stations": ["stop_id", "stop_name"],
    "dim_routes": ["route_id", "route_type"],
    "dim_trips": ["trip_id", "route_id", "service_id"],
}
