"""Aggregate building blocks (A-5, A-8, A-9, A-10, W-1, W-2).

All of them are plain ``groupBy().agg()`` so Spark runs a map-side partial
aggregate before each shuffle: a hot key is combined inside every task
before anything crosses the network.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_if(cond: Column) -> Column:
    """A-5: ``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as BIGINT."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def modal_value(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """A-8: the most frequent ``value`` per ``key``; ties go to the larger value.

    Counts per (key, value) then takes the greatest (count, value) per key, an
    aggregate that is partially combined map-side. Count and a whole number
    are packed into one decimal in their order, which a hash aggregate can
    hold; other types go as a struct, for which Spark sorts.
    """
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    kind = dict(df.dtypes)[value]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        shift, low = F.lit(Decimal(2**65)), F.lit(Decimal(2**63 + 1))  # NULL is 0, the least value 1
        code = F.when(F.col(value).isNull(), F.lit(Decimal(0))).otherwise(F.col(value).cast("decimal(19,0)") + low)
        packed = F.col("_n").cast("decimal(18,0)") * shift + code
        best = counts.groupBy(key).agg(F.max(packed).alias("_m")).withColumn("_m", F.col("_m") % shift)
        return best.select(key, F.when(F.col("_m") > 0, F.col("_m") - low).cast(kind).alias(out))
    best = counts.groupBy(key).agg(F.max(F.struct(F.col("_n"), F.col(value))).alias("_m"))
    return best.select(key, F.col("_m")[value].alias(out))


def modal_value_row_number(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """W-1: the reference's ROW_NUMBER form of ``modal_value`` (same result).

    The window is partitioned by ``key`` so rows are spread over tasks by
    key; kept for parity, ``modal_value`` is the cheaper plan.
    """
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(key).orderBy(F.col("_n").desc(), F.col(value).desc())
    return (counts.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).select(key, F.col(value).alias(out)))


def share_of_total(grouped: DataFrame, count_col: str, out: str, scale: int = 2) -> DataFrame:
    """A-9: ``round(100 * count / total, scale)`` per row of an aggregate.

    General form for any number of groups. The total is a scalar subquery
    over the same aggregate, so both need the same shuffle, which Spark runs
    once (``ReusedExchange``): the input is not computed twice. No job runs
    while the query is built, no join, no single-partition window.
    """
    total = grouped.agg(F.sum(count_col)).scalar()
    return grouped.withColumn(
        out, F.round(F.try_divide(F.lit(100.0) * F.col(count_col), total), scale))


def share_of_total_window(grouped: DataFrame, count_col: str, out: str,
                          scale: int = 2) -> DataFrame:
    """W-2: the same share via ``SUM(..) OVER ()`` — the reference's form.

    An empty window moves every row to one task; use it only on results whose
    row count is bounded by a fixed category set (Q4: three frequency
    classes; train categories: four). There it is the cheapest plan: one
    pass over the input, the window sees at most a handful of rows.
    """
    w = Window.partitionBy()
    return grouped.withColumn(
        out, F.round(F.try_divide(F.lit(100.0) * F.col(count_col), F.sum(count_col).over(w)),
                     scale))


def ratio(num: str, den: str, scale: int = 4) -> Column:
    """A-10: ``ROUND(CAST(num AS DOUBLE) / den, scale)``."""
    return F.round(F.col(num).cast("double") / F.col(den), scale)


def percent(num: str, den: str, scale: int = 2) -> Column:
    """A-10: ``ROUND(100.0 * CAST(num AS DOUBLE) / den, scale)`` (DOUBLE, not DECIMAL)."""
    return F.round(F.lit(100.0) * F.col(num).cast("double") / F.col(den), scale)


def minutes(seconds_sum: Column, n: Column | None = None, scale: int = 4) -> Column:
    """Seconds (summed as integers, T-14) -> minutes, divided last and rounded."""
    den = F.lit(60.0) if n is None else F.lit(60.0) * n
    return F.round(F.try_divide(seconds_sum.cast("double"), den), scale)
