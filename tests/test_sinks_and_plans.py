"""SNK-1..SNK-5 behaviour and physical-plan properties of the registered queries."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tramline.operators.aggregates import share_of_total
from tramline.sources import sinks as K

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # run, so AQE shows its final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_publish_is_all_or_nothing(spark, scratch):
    root = os.path.join(scratch, "wh")
    a = spark.createDataFrame([(1,)], "x int")
    K.publish_tables(spark, {"a": a, "b": a}, root, order=["a", "b"])
    bad = spark.createDataFrame([(2,), (2,)], "x int")

    def checks(staged):
        return ["duplicate x"] if staged["b"].groupBy("x").count().filter("count > 1").count() else []

    with pytest.raises(K.CheckFailed):
        K.publish_tables(spark, {"a": bad, "b": bad}, root, order=["a", "b"], checks=checks)
    # a failure half-way, with the first table written
    broken = spark.range(1).select(F.raise_error(F.lit("half-way")).cast("int").alias("x"))
    with pytest.raises(Exception, match="half-way"):
        K.publish_tables(spark, {"a": bad, "b": broken}, root, order=["a", "b"])
    # neither table changed
    assert [r.x for r in K.read_published(spark, root, "a").collect()] == [1]
    assert [r.x for r in K.read_published(spark, root, "b").collect()] == [1]
    K.publish_tables(spark, {"a": bad, "b": a}, root, order=["a", "b"])
    assert [r.x for r in K.read_published(spark, root, "a").collect()] == [2, 2]


def test_of_two_loads_at_once_one_wins(spark, scratch):
    root = os.path.join(scratch, "wh")
    one, two = (spark.createDataFrame([(x,)], "x int") for x in (1, 2))

    def meanwhile(written):  # another load finishes while this one checks
        K.publish_tables(spark, {"a": two}, root)
        return []
    with pytest.raises(K.LoadConflict):
        K.publish_tables(spark, {"a": one}, root, checks=meanwhile)
    assert [r.x for r in K.read_published(spark, root, "a").collect()] == [2]
    assert len([f for f in os.listdir(root) if f.startswith("version=")]) == 1  # the loser's folder is gone


def test_old_versions_go(spark, scratch):
    root = os.path.join(scratch, "wh")
    for k in range(5):
        K.publish_tables(spark, {"a": spark.createDataFrame([(k,)], "x int")}, root, keep=2)
    assert len([f for f in os.listdir(root) if f.startswith("version=")]) == 2 == len(K.versions(spark, root))
    assert [r.x for r in K.read_published(spark, root, "a").collect()] == [4]


def test_one_of_many_creates_a_file(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    path = os.path.join(scratch, "log", "1.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: K.put_if_absent(spark, path, f"writer {k}"), range(8)))
    assert sum(won) == 1 and open(path).read() == f"writer {won.index(True)}"
    assert os.listdir(os.path.dirname(path)) == ["1.json"]


def test_fact_layout_partitions_by_date(spark, scratch):
    p = os.path.join(scratch, "f")
    df = spark.createDataFrame([("t2", "2024-01-01 10:00:00"), ("t1", "2024-01-02 09:00:00")],
                               "trip_id string, fetched_at string").withColumn(
        "fetched_at", F.col("fetched_at").cast("timestamp_ntz"))
    K.write_fact_layout(df, p)
    got = spark.read.parquet(p).filter(F.col("fetched_date") == "2024-01-02")
    assert "PartitionFilters: [isnotnull(fetched_date" in got._jdf.queryExecution().executedPlan().toString()
    assert [r.trip_id for r in got.collect()] == ["t1"]


def test_bucketed_parent_child_join_has_no_shuffle(spark, scratch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parents = spark.range(0, 1000).select(F.col("id").alias("update_pk"),
                                              (F.col("id") % 7).alias("trip"))
        children = spark.range(0, 5000).select((F.col("id") % 1000).alias("update_pk"),
                                               F.col("id").alias("stop"))
        K.write_bucketed(parents, "tu_b", "update_pk", 8, os.path.join(scratch, "tu_b"))
        K.write_bucketed(children, "tsu_b", "update_pk", 8, os.path.join(scratch, "tsu_b"))
        j = spark.table("tsu_b").join(spark.table("tu_b"), "update_pk")
        plan = _plan(j)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def test_share_of_total_is_a_scalar_subquery(spark):
    g = spark.range(0, 100).groupBy((F.col("id") % 3).alias("k")).agg(F.count("*").alias("n"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    shares = share_of_total(g, "n", "pct")
    assert not tracker.getJobIdsForGroup("building")  # lazy
    assert shares.agg(F.sum("n")).first()[0] == 100 == sum(r.n for r in shares.collect())
    assert "ReusedExchange" in shares._jdf.queryExecution().executedPlan().toString()  # the groups are counted once
    plan = _plan(shares)
    lines = plan.split("\n")
    # The only single-partition exchange is the total's merge of per-task
    # partial sums (one row per task); the grouped rows never move to one task.
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            assert "partial_sum" in lines[i + 1]
    assert "Window" not in plan and "Subquery" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" not in plan


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_modal_value_is_a_hash_aggregate(spark, kind):
    from tramline.operators.aggregates import modal_value, modal_value_row_number
    edge = {"int": 2**31, "bigint": 2**63, "string": 9}[kind]
    rows = [(k, v) for k in range(40) for v in (None, None, -k, k % 3, k % 3, 5, -edge, edge - 1, edge - 1)[:1 + k % 9]]
    df = spark.createDataFrame(rows, "k int, v bigint").withColumn("v", F.col("v").cast(kind))
    got = modal_value(df, "k", "v", "m")
    want = modal_value_row_number(df.where("v IS NOT NULL OR k < 0"), "k", "v", "m")
    some = df.groupBy("k").agg(F.count("v").alias("n"), F.count("*").alias("a")).where("n = a").select("k")
    assert sorted(got.join(some, "k").collect()) == sorted(want.join(some, "k").collect())
    assert {r.k for r in got.where("m IS NULL").collect()} >= {0, 1}
    assert ("SortAggregate" in _plan(got)) == (kind == "string")


@needs_data
@pytest.mark.parametrize("key", sorted(E.catalog.queries()))
def test_no_python_udf_or_cross_join_in_any_query(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas", "PythonUDF"):
        assert node not in plan, f"{key} runs Python: {node}"
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{key} has a cross join: {node}"


@needs_data
def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["q1_peak_hours"](spark, SF))
    line = [ln for ln in plan.split("\n") if "lineitem.parquet" in ln][0]
    schema = line.split("ReadSchema: ")[1]
    assert "l_extendedprice" not in schema and "l_comment" not in schema
    assert "l_partkey" in schema


@needs_data
def test_filters_reach_the_scan(spark):
    from tramline.sources.tables import read_table
    df = read_table(spark, SF, "orders", "o_orderkey", "o_orderdate").filter(
        F.col("o_orderdate") < F.lit("1993-01-01").cast("timestamp_ntz"))
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan


def test_fact_layout_splits_a_hot_trip(spark, scratch):
    # one trip holds most rows of the day: it must still be written by several tasks
    p = os.path.join(scratch, "hot")
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.col("id").cast("string"))
         .alias("trip_id"),
        F.lit("2024-01-02 09:00:00").cast("timestamp_ntz").alias("fetched_at"),
        F.col("id"))
    K.write_fact_layout(df, p, num_partitions=8)
    files = [f for f in os.listdir(os.path.join(p, "fetched_date=2024-01-02"))
             if f.endswith(".parquet")]
    hot_files = [f for f in files
                 if spark.read.parquet(os.path.join(p, "fetched_date=2024-01-02", f))
                 .filter(F.col("trip_id") == "hot").limit(1).count()]
    assert len(hot_files) >= 3
    assert spark.read.parquet(p).count() == 20000


def _first_join_or_agg_above(plan: str, table: str) -> str:
    """Walk up from a table's scan in the plan tree; name the first join or aggregate."""
    lines = plan.split("== Initial Plan ==")[0].split("\n")
    idx = next(i for i, ln in enumerate(lines) if "FileScan" in ln and f"{table}.parquet" in ln)
    depth = len(lines[idx]) - len(lines[idx].lstrip(" :+-|"))
    for ln in reversed(lines[:idx]):
        d = len(ln) - len(ln.lstrip(" :+-|"))
        if d >= depth:
            continue  # a sibling subtree, not an ancestor
        depth = d
        node = ln.strip(" :+-|*()0123456789")
        if "Join" in node.split(" ")[0]:
            return "join"
        if "Aggregate" in node.split(" ")[0]:
            return "aggregate"
    return "none"


@needs_data
@pytest.mark.parametrize("key", ["q1_peak_hours", "join_three_way",
                                 "count_distinct_trips", "left_join_stations",
                                 "kpi_by_category", "hourly_matrix"])
def test_stop_rows_are_aggregated_before_any_join(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    assert _first_join_or_agg_above(plan, "lineitem") == "aggregate", key


def _above(plan: str, table: str) -> list[str]:
    """Nodes from a table's (first) scan up to the root."""
    lines = plan.split("== Initial Plan ==")[0].split("\n")
    idx = next(i for i, ln in enumerate(lines) if "FileScan" in ln and f"{table}.parquet" in ln)
    depth, out = len(lines[idx]) - len(lines[idx].lstrip(" :+-|")), []
    for ln in reversed(lines[:idx]):
        d = len(ln) - len(ln.lstrip(" :+-|"))
        if d < depth:
            depth = d
            out.append(ln.strip(" :+-|*()0123456789"))
    return out


@needs_data
@pytest.mark.parametrize("key", ["platform_congestion", "station_hourly_volume", "curated_stations",
                                 "station_ranking", "low_sample_flag", "canonical_station",
                                 "busy_multi_platform_stations", "station_peak_hour"])
def test_fact_rows_are_shuffled_once_on_the_snapshot(spark, key):
    """With broadcast joins off, as the big sides will be: stations first where they filter."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        nodes = _above(_plan(E.queries()[key](spark, SF)), "lineitem")
    finally:
        for n, v in before.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)
    shuffled = [n for n in nodes if n.startswith("Exchange") and "update_pk" in n]
    assert len(shuffled) == 1, nodes
    joins = [n for n in nodes if "Join" in n.split(" ")[0]]
    first = "stop_id" if key in ("platform_congestion", "station_hourly_volume", "curated_stations",
                                 "station_ranking") else "update_pk"
    assert first in joins[0]


@needs_data
def test_purge_and_orphan_checks_find_something(spark):
    sf = "/root/testdata/sf0.01"
    row = E.queries()["cascade_purge"](spark, sf).first()
    assert row.purged_parents > 0 and row.kept_parents > 0
    assert all(r.violations > 0 for r in E.queries()["fk_violations"](spark, sf).collect())
