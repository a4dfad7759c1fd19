"""Registry of checked queries: key -> (Spark callable, DuckDB oracle SQL).

Each callable takes ``(spark, sf_dir)``, derives the transit-shaped inputs
from the driver tables (``tramline.sources.standins``) and returns a lazy
DataFrame over the whole tables. The SQL twin computes the same answer in
DuckDB from the same parquet files; column names match one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules fills the registry.
    from tramline.plans import (  # noqa: F401
        catalog_schedule, catalog_quality, catalog_realtime, catalog_punctuality,
    )


# Registered outputs with DATE / TIMESTAMP columns. Both engines emit them as
# ISO text (microseconds for timestamps) so a value hash cannot depend on how
# each client library represents temporal types; the operators themselves
# compute real DATE / TIMESTAMP values.
TEMPORAL: dict[str, dict[str, str]] = {
    "parse_compact_date": {"iso_date": "date"},
    "rt_trip_updates": {"update_timestamp": "ts", "fetched_at": "ts"},
    "rt_trip_stop_updates": {"arrival_time": "ts", "departure_time": "ts"},
    "epoch_to_ts": {"departure_time": "ts"},
    "rt_service_alerts": {"fetched_at": "ts"},
    "rt_alert_periods": {"period_start": "ts", "period_end": "ts"},
    "latest_update_flag": {"update_timestamp": "ts"},
    "latest_per_trip": {"ts": "ts"},
}
_SPARK_FMT = {"date": "yyyy-MM-dd", "ts": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
_DUCK_FMT = {"date": "%Y-%m-%d", "ts": "%Y-%m-%d %H:%M:%S.%f"}


def _as_text_spark(fn, cols):
    from pyspark.sql import functions as F

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.withColumns({c: F.date_format(c, _SPARK_FMT[k]) for c, k in cols.items()})
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _as_text_sql(sql: str, cols: dict[str, str]) -> str:
    repl = ", ".join(f"strftime({c}, '{_DUCK_FMT[k]}') AS {c}" for c, k in cols.items())
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: (_as_text_spark(fn, TEMPORAL[k]) if k in TEMPORAL else fn)
            for k, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: (_as_text_sql(sql, TEMPORAL[k]) if k in TEMPORAL else sql)
            for k, sql in ORACLE.items()}
