"""Names that mean one station (SC-14): spellings in several languages as connected components.

A station has its name's parts (``A / B`` has two spellings) and what these
are translated to. Stations that share a spelling, directly or through
others, are one place, with the smallest of their ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = r"\s*/\s*"  # between the spellings of one name


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """node, component: the smallest node that each node of an edge can reach.

    Every round a node takes the smallest label of its neighbours, and then
    the label of its label, so labels travel twice as far each time. Labels
    are checkpointed (they outlive executors), and only the number of labels
    that changed comes to the driver. Null ends are no nodes.
    """
    both = edges.select(F.col(u).alias("node"), F.col(v).alias("other")).where("node IS NOT NULL AND other IS NOT NULL")
    both = both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct().checkpoint()
    labels = both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")).checkpoint()
    while True:
        near = (both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node")
                .agg(F.min("component").alias("near")))
        lower = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("low"))
        of = lower.select(F.col("node").alias("low"), F.col("low").alias("jump"))
        moved = lower.join(of, "low", "left").select("node", "component", F.least("low", F.coalesce("jump", "low")).alias("new"))
        moved = moved.checkpoint()
        if moved.where("new <> component").isEmpty():
            return labels
        labels = moved.select("node", F.col("new").alias("component"))


def _spelling(name: Column) -> Column:
    """A spelling as a node: without case and outer space; the empty one is none."""
    return F.nullif(F.lower(F.trim(name)), F.lit(""))


def station_aliases(stations: DataFrame, translations: DataFrame, id_col: str = "stop_id") -> DataFrame:
    """``id_col`` and ``canonical_id`` (the smallest id of the place) of every row of ``stations``.

    ``translations`` are those of the feed (table_name, field_name,
    field_value, translation), in any language. A station without a name is a
    place of its own. Ids are compared as text.
    """
    own = stations.select(F.col(id_col).cast("string").alias("id"), "stop_name").where("id IS NOT NULL").distinct()
    named = own.select("id", F.explode(F.split("stop_name", SEPARATOR)).alias("name"))
    tr = translations.filter((F.col("table_name") == "stops") & (F.col("field_name") == "stop_name"))
    said = tr.select("field_value", F.explode(F.split("translation", SEPARATOR)).alias("name"))
    said = said.select(F.explode(F.split("field_value", SEPARATOR)).alias("value"), "name")
    # nodes: ids and spellings, told apart by their first letter; ids are the smaller ones
    edges = (named.select(F.concat(F.lit("i"), "id").alias("u"), F.concat(F.lit("n"), _spelling(F.col("name"))).alias("v"))
             .unionByName(said.select(F.concat(F.lit("n"), _spelling(F.col("value"))).alias("u"),
                                      F.concat(F.lit("n"), _spelling(F.col("name"))).alias("v"))))
    found = components(edges).where("node LIKE 'i%'").select(
        F.expr("substring(node, 2)").alias("id"), F.expr("substring(component, 2)").alias("canonical_id"))
    return (stations.select(F.col(id_col)).withColumn("id", F.col(id_col).cast("string")).join(found, "id", "left")
            .select(id_col, F.coalesce("canonical_id", "id").alias("canonical_id")))
