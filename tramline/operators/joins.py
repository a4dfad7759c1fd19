"""Join building blocks (J-5, J-7, J-9, J-10, F-10).

No explicit ``broadcast()`` here: every side below grows with the feed, so
Spark decides from its size estimate / AQE runtime size whether to
broadcast (``spark.sql.autoBroadcastJoinThreshold``); above the threshold
it shuffles, and AQE splits skewed partitions of a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def translate_names(stops: DataFrame, translations: DataFrame, language: str) -> DataFrame:
    """J-10: ``display_name`` = the translation of ``stop_name`` or the name itself.

    Translations are keyed by value (``field_value = stop_name``), not by id.
    """
    tr = translations.filter(
        (F.col("table_name") == "stops") & (F.col("field_name") == "stop_name")
        & (F.col("language") == language)
    ).select(F.col("field_value").alias("_v"), F.col("translation").alias("_t"))
    j = stops.join(tr, stops["stop_name"] == tr["_v"], "left")
    return j.withColumn("display_name", F.coalesce("_t", "stop_name")).drop("_v", "_t")


def left_join_stations(fact: DataFrame, stations: DataFrame,
                       cols=("stop_name", "parent_station", "platform_code")) -> DataFrame:
    """J-7: soft reference fact.stop_id -> dim_stations (unknown ids keep NULLs)."""
    return fact.join(stations.select("stop_id", *cols), "stop_id", "left")


def split_orphans(child: DataFrame, parent: DataFrame, child_key: str,
                  parent_key: str) -> tuple[DataFrame, DataFrame]:
    """J-5: (kept, rejected) — kept children reference an existing parent.

    A NULL reference is rejected, as in the reference loader.
    """
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    cond = child[child_key] == p["_pk"]
    kept = child.join(p, cond, "left_semi")
    rejected = child.join(p, cond, "left_anti")
    return kept, rejected


def orphan_counts(child: DataFrame, parent: DataFrame, child_key: str,
                  parent_key: str) -> DataFrame:
    """J-5 summary in one pass: left join + conditional counts -> one row."""
    p = (parent.select(F.col(parent_key).alias("_pk")).distinct()
         .withColumn("_hit", F.lit(True)))
    j = child.select(F.col(child_key).alias("_ck")).join(p, F.col("_ck") == F.col("_pk"), "left")
    return j.agg(
        F.count_if(F.col("_hit").isNotNull()).alias("kept"),
        F.count_if(F.col("_hit").isNull()).alias("rejected"),
    )


def parent_child(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """J-9: children with their parent's columns, by surrogate key."""
    return child.join(parent, key)
