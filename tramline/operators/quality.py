"""Keys and integrity checks (KEY-*, CHK-1..CHK-6, CLN-5).

Each check is one distributed job whose output is small by construction
(violating keys, or one count per checked column). Nothing is collected
except CLN-5's single row of per-column counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, keys) -> DataFrame:
    """CHK-1: key values that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def _per_column(df: DataFrame, exprs: dict, value_name: str) -> DataFrame:
    """One aggregate over all columns -> (column_name, value) rows."""
    one = df.agg(*[e.alias(c) for c, e in exprs.items()])
    return one.unpivot([], list(exprs), "column_name", value_name)


def not_null_violations(df: DataFrame, columns) -> DataFrame:
    """CHK-2: NULL count of every NOT NULL column, in one pass."""
    return _per_column(df, {c: F.count_if(F.col(c).isNull()) for c in columns},
                       "null_count")


def width_violations(df: DataFrame, widths: dict) -> DataFrame:
    """CHK-5: values longer than the declared width (characters), per column."""
    return _per_column(df, {c: F.count_if(F.length(c) > F.lit(n)) for c, n in widths.items()},
                       "violations")


def fk_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str
                  ) -> DataFrame:
    """CHK-3: references without a parent (NULL allowed) and how many child rows have them.

    Child rows are counted per reference first, so a reference that many
    rows share is one row in the join, and the parent's keys need no distinct.
    """
    counts = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    p = parent.select(F.col(parent_column).alias("_ref"))
    return counts.join(p, "_ref", "left_anti").select(F.col("_ref").alias(column), "n_rows")


def fk_report(checks) -> DataFrame:
    """CHK-3 for several foreign keys: one row per (child, column, parent) with a count.

    ``checks`` = [(child_name, child_df, column, parent_name, parent_df, parent_column)].
    The per-check counts are unioned, then one aggregate.
    """
    parts = [fk_violations(cdf, col, pdf, pcol).select(
        F.lit(cn).alias("child_table"), F.lit(col).alias("child_column"),
        F.lit(pn).alias("parent_table"), "n_rows")
        for cn, cdf, col, pn, pdf, pcol in checks]
    found = reduce(DataFrame.unionByName, parts).groupBy(
        "child_table", "child_column", "parent_table").agg(
        F.sum("n_rows").alias("violations"))
    spark = checks[0][1].sparkSession
    names = spark.createDataFrame([(cn, col, pn) for cn, _, col, pn, _, _ in checks],
                                  "child_table string, child_column string, parent_table string")
    return names.join(found, ["child_table", "child_column", "parent_table"], "left").select(
        "child_table", "child_column", "parent_table",
        F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"))


def unique_per_poll(df: DataFrame, keys=("entity_id", "fetched_at")) -> DataFrame:
    """CHK-4: (entity_id, fetched_at) pairs seen more than once."""
    return pk_violations(df, list(keys))


def cascade_purge(parents: DataFrame, children: DataFrame, key: str, purge_when
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """CHK-6: delete parents matching ``purge_when`` and, with them, their children.

    Returns (kept_parents, kept_children, purged_keys). Children go by
    ``left_anti`` against the purged keys (a join, not a collected list).
    """
    purged = parents.filter(purge_when).select(key).distinct()
    kept_parents = parents.filter(~purge_when | purge_when.isNull())
    kept_children = children.join(purged, key, "left_anti")
    return kept_parents, kept_children, purged


def empty_columns(df: DataFrame) -> list[str]:
    """CLN-5 helper: columns that are NULL or '' in every row (one job, one row back)."""
    if not df.columns:
        return []
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count(F.nullif(F.col(c).cast("string"), F.lit(""))).alias(f"__c{i}")
                      for i, c in enumerate(df.columns)]).first()
    # An empty table keeps all its columns (nothing to inspect).
    if counts is None or counts["__rows"] == 0:
        return []
    return [c for i, c in enumerate(df.columns) if counts[f"__c{i}"] == 0]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """CLN-5: drop the columns that are empty in every row."""
    empty = empty_columns(df)
    return df.drop(*empty) if empty else df
