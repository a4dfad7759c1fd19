"""Dimension builders (CLN-8) over raw all-string GTFS tables.

Cleaning follows the reference loader: strip, blank -> NULL, truncate to
the column width (characters), digits-only integers, defaults for a blank
station name / service id and for a missing or 0 route type. A column that a
feed leaves out counts as blank. Trips whose
route is not in ``dim_routes`` are rejected and counted (J-5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.text import (
    UNKNOWN_SERVICE, UNKNOWN_STATION, clean_digits, clean_text, default_fill,
    default_route_type,
)
from tramline.operators.joins import orphan_counts, split_orphans
from tramline.sources.schemas import DIM_WIDTHS


def _col_or_null(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def dim_stations(raw_stops: DataFrame) -> DataFrame:
    w = DIM_WIDTHS["dim_stations"]
    return raw_stops.select(
        clean_text(_col_or_null(raw_stops, "stop_id"), w["stop_id"]).alias("stop_id"),
        default_fill(clean_text(_col_or_null(raw_stops, "stop_name"), w["stop_name"]), UNKNOWN_STATION).alias("stop_name"),
        clean_text(_col_or_null(raw_stops, "parent_station"), w["parent_station"]).alias("parent_station"),
        clean_text(_col_or_null(raw_stops, "platform_code"), w["platform_code"]).alias("platform_code"),
        clean_digits(_col_or_null(raw_stops, "wheelchair_boarding")).alias("wheelchair_boarding"),
    )


def dim_routes(raw_routes: DataFrame, falsy_zero: bool = True) -> DataFrame:
    w = DIM_WIDTHS["dim_routes"]
    return raw_routes.select(
        clean_text(_col_or_null(raw_routes, "route_id"), w["route_id"]).alias("route_id"),
        clean_text(_col_or_null(raw_routes, "agency_id"), w["agency_id"]).alias("agency_id"),
        clean_text(_col_or_null(raw_routes, "route_short_name"), w["route_short_name"]).alias("route_short_name"),
        clean_text(_col_or_null(raw_routes, "route_long_name"), w["route_long_name"]).alias("route_long_name"),
        default_route_type(clean_digits(_col_or_null(raw_routes, "route_type")), falsy_zero).alias("route_type"),
    )


def _clean_trips(raw_trips: DataFrame) -> DataFrame:
    w = DIM_WIDTHS["dim_trips"]
    return raw_trips.select(
        clean_text(_col_or_null(raw_trips, "trip_id"), w["trip_id"]).alias("trip_id"),
        clean_text(_col_or_null(raw_trips, "route_id"), w["route_id"]).alias("route_id"),
        default_fill(clean_text(_col_or_null(raw_trips, "service_id"), w["service_id"]), UNKNOWN_SERVICE).alias("service_id"),
        clean_text(_col_or_null(raw_trips, "trip_headsign"), w["trip_headsign"]).alias("trip_headsign"),
        clean_digits(_col_or_null(raw_trips, "bikes_allowed")).alias("bikes_allowed"),
        clean_digits(_col_or_null(raw_trips, "wheelchair_accessible")).alias("wheelchair_accessible"),
    )


def dim_trips(raw_trips: DataFrame, routes_dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept trips, rejected trips): kept ones reference an existing route."""
    return split_orphans(_clean_trips(raw_trips), routes_dim, "route_id", "route_id")


def dim_trips_counts(raw_trips: DataFrame, routes_dim: DataFrame) -> DataFrame:
    """J-5 summary row (kept, rejected) in one join + aggregate."""
    return orphan_counts(_clean_trips(raw_trips), routes_dim, "route_id", "route_id")
