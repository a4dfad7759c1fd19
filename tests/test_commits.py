"""SNK-4, SNK-5, SNK-6, CHK-6 on the commit log: file counts, replays, compaction, purge, conflicts."""

import datetime as dt
import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tramline.operators import realtime as R
from tramline.sources import commits as C
from tramline.streaming import ingest as S

DAY = 1704441600  # 2024-01-05 08:00 UTC


def _trip_poll(stamp, n=2, delay=0):
    return {"header": {"timestamp": stamp}, "entity": [
        {"id": f"e{k}", "tripUpdate": {"trip": {"tripId": f"t{k}"}, "delay": delay, "stopTimeUpdate": [
            {"stopSequence": 1, "stopId": f"s{k}"}, {"stopSequence": 2, "stopId": "s9"}]}} for k in range(n)]}


def _alert_poll(stamp):
    return {"header": {"timestamp": stamp}, "entity": [{"id": "a1", "alert": {
        "cause": 1, "activePeriod": [{"start": stamp}], "informedEntity": [{"stopId": "s9"}],
        "headerText": {"translation": [{"language": "fr", "text": "Retard"}]}}}]}


def _lines(folder, name, polls):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("".join(json.dumps(p) + "\n" for p in polls))
    return folder


def _batch(spark, scratch, name, trips, alerts=()):
    t = _lines(os.path.join(scratch, name, "trip"), "p.jsonl", trips)
    a = _lines(os.path.join(scratch, name, "alert"), "a.jsonl", alerts)
    return R.read_poll_files(spark, t, "trip-update", one_poll_per_file=False).unionByName(
        R.read_poll_files(spark, a, "alert", one_poll_per_file=False))


def _files(spark, root, table):
    return {r.path for r in C.live_files(spark, root).where(F.col("table") == table).collect()}


def _orphans(spark, root):
    pairs = [("trip_updates", "update_pk", "trip_stop_updates")] + [("service_alerts", "alert_pk", c) for c in R.ALERT_CHILDREN]
    return sum(S.read_committed(spark, root, child).join(S.read_committed(spark, root, parent), key, "left_anti").count()
               for parent, key, child in pairs)


def test_ten_thousand_polls_share_files(spark, scratch):
    out = os.path.join(scratch, "out")
    polls = [_trip_poll(DAY + k % 40000, n=1, delay=k) for k in range(10_000)]
    batch = _batch(spark, scratch, "in", polls, [_alert_poll(DAY + k) for k in range(50)])
    S.flatten_batch(batch, out)
    counts = {t: S.read_committed(spark, out, t).count() for t in S.POLL_TABLES if t != "rejected"}
    assert counts["trip_updates"] == counts["trip_stop_updates"] / 2 == 10_000 and counts[S.COMMITTED] == 10_050
    assert all(len(_files(spark, out, t)) < 100 for t in S.POLL_TABLES)
    S.flatten_batch(batch, out)  # the same polls by another run
    assert {t: S.read_committed(spark, out, t).count() for t in counts} == counts
    assert S.compact(spark, out) is not None
    assert {t: S.read_committed(spark, out, t).count() for t in counts} == counts
    assert all(C.read_table(spark, out, t).count() == n for t, n in counts.items())  # replaced rows are gone for good
    assert not _files(spark, out, S.REPLACED)


def test_a_poll_without_rows_takes_its_old_rows_away(spark, scratch):
    out = os.path.join(scratch, "out")
    batch = _batch(spark, scratch, "in", [_trip_poll(DAY)], [_alert_poll(DAY)])
    stations = spark.createDataFrame([("s0", "Gent"), ("zz", "Nowhere")], "stop_id string, stop_name string")
    S.flatten_batch(batch, out)
    assert S.read_committed(spark, out, "trip_updates").count() == 2
    S.flatten_batch(batch, out, stations, "Nowhere")
    assert S.read_committed(spark, out, "trip_updates").count() == 0
    assert S.read_committed(spark, out, "trip_stop_updates").count() == 0
    assert S.read_committed(spark, out, "service_alerts").count() == 1
    S.flatten_batch(batch, out, stations, "gen")
    assert [r.trip_id for r in S.read_committed(spark, out, "trip_updates").collect()] == ["t0"]


def test_rejected_rows_are_one_table(spark, scratch):
    out = os.path.join(scratch, "out")
    poll = _trip_poll(DAY, n=500)
    for e in poll["entity"]:
        del e["tripUpdate"]["stopTimeUpdate"][0]["stopId"]
    batch = _batch(spark, scratch, "in", [poll])
    with pytest.raises(R.InvalidFeedRows):
        S.flatten_batch(batch, out)
    assert C.latest_version(spark, out) == 0
    S.flatten_batch(batch, out, on_invalid="quarantine")
    S.flatten_batch(batch, out, on_invalid="quarantine")
    rejected = S.read_committed(spark, out, "rejected")
    assert rejected.count() == 500 and len(_files(spark, out, "rejected")) < 20
    assert rejected.select("poll_id").distinct().collect() == S.read_committed(spark, out, S.COMMITTED).select("poll_id").collect()


def test_run_summary_is_observed(spark, scratch, monkeypatch):
    out = os.path.join(scratch, "out")
    batch = _batch(spark, scratch, "in", [_trip_poll(DAY, 3), _trip_poll(DAY + 60, 2), {"entity": [{"id": "x"}]}], [_alert_poll(DAY)])
    stations = spark.createDataFrame([("s1", "Gent"), ("s2", "Gentbrugge")], "stop_id string, stop_name string")
    plans, write = [], C.stage
    monkeypatch.setattr(C, "stage", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, *a))
    S.flatten_batch(batch, out, stations, "gent")
    assert len(plans) >= 8 and not any("StructField(entity" in p for p in plans)  # outputs read the parsed polls
    trips, alerts = batch.filter("feed = 'trip-update'"), batch.filter("feed = 'alert'")
    want = R.flatten(trips, alerts, stations, "gent")["summary"].first()
    got = C.read_table(spark, out, S.RUNS).select(*want.asDict()).first()
    assert got == want and got.trips_inserted == 3 and got.resolved_stop_ids_count == 2
    per_poll = S.read_committed(spark, out, "summary").groupBy().sum("total_trips_fetched", "trips_inserted", "alerts_processed")
    assert per_poll.first()[:] == (want.total_trips_fetched, want.trips_inserted, want.alerts_processed)


def _three_days(spark, scratch):
    out = os.path.join(scratch, "out")
    for k in range(3):
        stamps = [DAY + 86400 * d + 3600 * k for d in range(3)]
        S.flatten_batch(_batch(spark, scratch, f"in{k}", [_trip_poll(x, delay=k) for x in stamps],
                               [_alert_poll(x) for x in stamps]), out)
    return out


def test_compaction_under_readers(spark, scratch):
    out = _three_days(spark, scratch)
    before = {t: _files(spark, out, t) for t in S.FACT_TABLES}
    version = C.latest_version(spark, out)
    rows = lambda v=None: sorted(map(str, S.read_committed(spark, out, "trip_stop_updates", v).collect()))
    old, reader = rows(), S.read_committed(spark, out, "trip_stop_updates")
    assert S.compact(spark, out, days=["2024-01-06"]) == version + 1
    after = {t: _files(spark, out, t) for t in S.FACT_TABLES}
    for t in S.FACT_TABLES:
        other = {p for p in before[t] if "2024-01-06" not in p}
        assert other < after[t] and len(after[t] - other) == 1
    assert rows() == old == rows(version) == sorted(map(str, reader.collect()))
    day = S.read_committed(spark, out, "trip_stop_updates").filter("fetched_date = '2024-01-06'")
    assert "PartitionFilters: [isnotnull(fetched_date" in day._jdf.queryExecution().executedPlan().toString()
    assert len(S.read_committed(spark, out, "trip_stop_updates", days=["2024-01-06"]).inputFiles()) == 1
    assert S.compact(spark, out, days=["2024-01-06"]) is None
    assert C.vacuum(spark, out, keep_versions=0, unused_for=timedelta(0)) == 3 * len(S.POLL_TABLES) - 3  # no rejected rows
    assert rows() == old


def test_commits_on_the_same_days_conflict(spark, scratch, monkeypatch):
    out = _three_days(spark, scratch)
    write = C.stage

    def meanwhile(df, root, table, sort_col=None):  # another batch commits while files are being rewritten
        monkeypatch.setattr(C, "stage", write)
        S.flatten_batch(_batch(spark, scratch, "late", [_trip_poll(DAY + 5, delay=9)]), out)
        return write(df, root, table, sort_col)
    monkeypatch.setattr(C, "stage", meanwhile)
    with pytest.raises(C.Conflict):
        S.compact(spark, out, days=["2024-01-05"])
    monkeypatch.setattr(C, "stage", meanwhile)
    assert S.compact(spark, out, days=["2024-01-06"]) is not None  # other days: goes behind
    assert S.read_committed(spark, out, "trip_updates").count() == 20


def test_purge_leaves_no_orphans_and_other_files(spark, scratch, monkeypatch):
    out = _three_days(spark, scratch)
    before = {t: _files(spark, out, t) for t in S.POLL_TABLES}
    cut = dt.datetime(2024, 1, 6, 9, 30)  # the first day, and two of three polls of the second
    for t in S.FACT_TABLES:  # the first day goes unread: its files are not even there
        for p in before[t]:
            if "2024-01-05" in p:
                with open(os.path.join(out, t, p), "w") as f:
                    f.write("not parquet")
    write, calls = C.stage, []

    def fails(df, root, table, sort_col=None):
        calls.append(table)
        if len(calls) == 2:
            raise RuntimeError("lost between two tables")
        return write(df, root, table, sort_col)
    monkeypatch.setattr(C, "stage", fails)
    version = C.latest_version(spark, out)
    with pytest.raises(RuntimeError, match="between"):
        S.purge(spark, out, cut)
    assert C.latest_version(spark, out) == version and {t: _files(spark, out, t) for t in S.POLL_TABLES} == before
    monkeypatch.setattr(C, "stage", write)
    assert S.purge(spark, out, cut) == version + 1
    assert _orphans(spark, out) == 0
    assert S.read_committed(spark, out, "trip_updates").agg(F.min("fetched_at")).first()[0] >= cut
    assert {t: S.read_committed(spark, out, t).count() for t in ("trip_updates", "trip_stop_updates", S.COMMITTED)} == {
        "trip_updates": 8, "trip_stop_updates": 16, S.COMMITTED: 8}
    for t in S.FACT_TABLES:
        after = _files(spark, out, t)
        assert {p for p in before[t] if "2024-01-07" in p} <= after and not any("2024-01-05" in p for p in after)
        assert len([p for p in before[t] if "2024-01-06" in p and p in after]) == 1  # the file of the third poll
    assert S.purge(spark, out, cut) is None


def test_purge_by_day_reads_nothing(spark, scratch):
    out = _three_days(spark, scratch)
    assert S.purge(spark, out, dt.datetime(2024, 1, 7)) is not None
    assert S.read_committed(spark, out, "alert_texts").count() == 3 and _orphans(spark, out) == 0


def test_log_is_listed_from_time_to_time(spark, scratch, monkeypatch):
    monkeypatch.setattr(C, "SNAPSHOT_EVERY", 2)
    root = os.path.join(scratch, "t")
    df = spark.range(1).withColumn(C.DATE, F.lit("2024-01-05").cast("date"))
    for _ in range(5):
        C.commit(spark, root, [C.stage(df, root, "a")])
    assert C.read_table(spark, root, "a").count() == 5 and C.read_table(spark, root, "a", 3).count() == 3
    assert {n for n in os.listdir(os.path.join(root, C.LOG)) if "live" in n} == {"000000000002.live.json", "000000000004.live.json"}
    with pytest.raises(KeyError):
        C.read_table(spark, root, "b")


def test_ingested_parents_join_children_without_a_shuffle(spark, scratch):
    from tramline.operators.joins import parent_child
    out = _three_days(spark, scratch)
    names = S.publish_bucketed(spark, out, os.path.join(scratch, "bucketed"), "b" + os.path.basename(scratch).replace("-", "_"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for parent, key, child in (("trip_updates", "update_pk", "trip_stop_updates"), ("service_alerts", "alert_pk", "alert_texts")):
            parents = spark.table(names[parent]).select(key, "entity_id")
            joined = parent_child(parents, spark.table(names[child]).drop("entity_id"), key)
            joined.write.format("noop").mode("overwrite").save()
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            assert joined.count() == S.read_committed(spark, out, child).count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
