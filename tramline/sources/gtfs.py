"""GTFS static feed reader (SRC-1, SRC-2) and schema projection (CLN-1, CLN-2).

Files are read as text first (every value a string, like the reference's
DictReader), then projected onto the declared schema and cast.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.text import cast_lenient, cast_strict, empty_to_null
from tramline.sources.schemas import GTFS_LOAD_ORDER, GTFS_NOT_NULL, GTFS_TABLES, KIND_TO_SQL
from tramline.sources.sinks import path_exists

class MissingFeedFile(FileNotFoundError):
    pass


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: one GTFS text file, header row, BOM stripped, all columns STRING.

    ``escape='"'`` keeps doubled quotes inside quoted fields intact; short
    rows give NULL for the missing trailing columns; blank lines are skipped.
    Every table is read with quoted line breaks allowed. That makes a file
    one task; a table too big for that can be a folder of files, each with
    the header, at the same path.
    """
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("escape", '"').option("multiLine", True)
          .option("encoding", "UTF-8").option("mode", "PERMISSIVE").csv(path))
    # A UTF-8 BOM can survive in the first header name; strip it.
    return df.toDF(*[c.lstrip("\ufeff").strip() for c in df.columns])


def project_to_schema(df: DataFrame, columns, strict: bool = True) -> DataFrame:
    """CLN-1: the declared columns in order; absent -> NULL; extras dropped.

    ``columns`` = [(name, "str"|"int"|"float")]. '' becomes NULL, then an
    ANSI cast (bad text raises, like the reference) or, with
    ``strict=False``, ``try_cast`` (bad text becomes NULL).
    """
    cast = cast_strict if strict else cast_lenient
    have = set(df.columns)
    out = []
    for name, kind in columns:
        target = KIND_TO_SQL[kind]
        if name not in have:
            out.append(F.lit(None).cast(target).alias(name))
        elif kind == "str":
            out.append(F.nullif(F.col(name), F.lit("")).alias(name))
        else:
            out.append(cast(F.col(name), target).alias(name))
    return df.select(*out)


BAD_VALUES = "table_name string, column_name string, value string, row_text string, kept boolean"


def project_with_report(df: DataFrame, table: str, columns, not_null=()) -> tuple[DataFrame, DataFrame]:
    """CLN-2, quarantine: the rows with NULL for text that does not fit, and a report of it.

    The report has each such text (``BAD_VALUES``) with its row as JSON. A
    row with one in a ``not_null`` column is not kept, so rows kept and rows
    reported as not kept make up the input.
    """
    have = set(df.columns)
    numbers = [(c, kind) for c, kind in columns if kind != "str" and c in have]
    bad = {c: empty_to_null(F.col(c)).isNotNull() & cast_lenient(F.col(c), KIND_TO_SQL[kind]).isNull() for c, kind in numbers}
    listed = F.array_compact(F.array(*(F.when(b, F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))
                                       for c, b in bad.items()))) if bad else F.array()
    lost = reduce(lambda a, b: a | b, [b for c, b in bad.items() if c in not_null], F.lit(False))
    marked = df.withColumn("__kept", ~lost)
    kept = project_to_schema(marked.filter("__kept"), columns, strict=False)
    if not bad:
        return kept, df.sparkSession.createDataFrame([], BAD_VALUES)
    report = marked.select(F.lit(table).alias("table_name"), F.inline(listed),
                           F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("row_text"), F.col("__kept").alias("kept"))
    return kept, report.select("table_name", "column_name", "value", "row_text", "kept")


def read_feed_with_report(spark: SparkSession, feed_dir: str, tables=None) -> tuple[dict[str, DataFrame], DataFrame]:
    """SRC-2, quarantine: the tables of a feed, and what text in them did not fit (see ``project_with_report``)."""
    raw = _feed_texts(spark, feed_dir, tables)
    out, reports = {}, []
    for t, df in raw.items():
        out[t], report = project_with_report(df, t, GTFS_TABLES[t], GTFS_NOT_NULL[t])
        reports.append(report)
    return out, reduce(DataFrame.unionByName, reports, spark.createDataFrame([], BAD_VALUES))


def read_feed(spark: SparkSession, feed_dir: str, tables=None, strict: bool = True,
              required=None) -> dict[str, DataFrame]:
    """SRC-2: the named tables of a feed, typed.

    A missing required file fails here, before anything is written.
    """
    return {t: project_to_schema(raw, GTFS_TABLES[t], strict)
            for t, raw in _feed_texts(spark, feed_dir, tables, required).items()}


def _feed_texts(spark: SparkSession, feed_dir: str, tables=None, required=None) -> dict[str, DataFrame]:
    tables = list(tables or GTFS_LOAD_ORDER)
    required = set(required if required is not None else tables)
    there = {t: path_exists(spark, os.path.join(feed_dir, f"{t}.txt")) for t in tables}
    missing = [t for t in tables if t in required and not there[t]]
    if missing:
        raise MissingFeedFile(f"missing GTFS files: {', '.join(m + '.txt' for m in missing)}")
    return {t: read_csv_text(spark, os.path.join(feed_dir, f"{t}.txt")) for t in tables if there[t]}


def read_feed_text(spark: SparkSession, feed_dir: str, table: str) -> DataFrame:
    """One table as raw text (for the dimension loaders)."""
    return read_csv_text(spark, os.path.join(feed_dir, f"{table}.txt"))
