"""STR-1..STR-3 and SNK-4: the poll stream equals the batch result; replays change nothing."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tramline.operators import realtime as R
from tramline.sources import commits as C
from tramline.streaming import ingest as S

from tests.test_realtime import ALERT_POLL, TRIP_POLL


def _stage(folder, sub, name, payload):
    d = os.path.join(folder, sub)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        json.dump(payload, f)
    return d


def _second_poll():
    p = json.loads(json.dumps(TRIP_POLL))
    p["entity"][0]["tripUpdate"]["timestamp"] = {"low": 0, "high": 1}
    p["entity"][0]["tripUpdate"]["delay"] = 120
    return p


def _rows(spark, out, table, cols):
    return sorted(tuple(r) for r in S.read_committed(spark, out, table).select(*cols).collect())


def _ingest(spark, scratch, tdir, adir, out, ck, **options):
    q = S.start_ingest(spark, tdir, adir, out, checkpoint=os.path.join(scratch, ck), **options)
    q.awaitTermination(120)


COLS = ["update_pk", "entity_id", "trip_id", "overall_delay", "update_timestamp"]
STOP_COLS = ["id", "update_pk", "stop_sequence", "stop_id"]


def _expected(spark, dirs, adir):
    from functools import reduce
    polls = reduce(lambda a, b: a.unionByName(b), [R.read_poll_files(spark, t, "trip-update") for t in dirs])
    batch = R.flatten(polls, R.read_poll_files(spark, adir, "alert"))
    return [sorted(tuple(r) for r in batch[t].select(*c).collect())
            for t, c in (("trip_updates", COLS), ("trip_stop_updates", STOP_COLS))]


def _written(spark, out):
    return [_rows(spark, out, "trip_updates", COLS), _rows(spark, out, "trip_stop_updates", STOP_COLS)]


def test_stream_matches_batch_whatever_the_batches(spark, scratch):
    tdir = _stage(scratch, "trip", "p1.json", TRIP_POLL)
    _stage(scratch, "trip", "p2.json", _second_poll())
    adir = _stage(scratch, "alert", "a1.json", ALERT_POLL)
    out = os.path.join(scratch, "out")
    expected = _expected(spark, [tdir], adir)
    assert [len(x) for x in expected] == [6, 6]

    _ingest(spark, scratch, tdir, adir, out, "ck1", max_files_per_trigger=1)
    assert _written(spark, out) == expected
    # replayed from nothing in other batches: each poll replaces itself
    _ingest(spark, scratch, tdir, adir, out, "ck2")
    assert _written(spark, out) == expected
    # a second folder under a new checkpoint adds to the first, whose rows stay
    other = _stage(scratch, "later", "p3.json", {**_second_poll(), "header": {"timestamp": 1704500000}})
    empty = os.path.join(scratch, "no-alerts")
    os.makedirs(empty)
    _ingest(spark, scratch, other, empty, out, "ck3")
    assert _written(spark, out) == _expected(spark, [tdir, other], adir)
    assert S.read_committed(spark, out, "alert_texts").count() == 3
    summary = S.read_committed(spark, out, "summary")
    assert summary.agg(F.sum("total_trips_fetched"), F.sum("trips_inserted"),
                       F.sum("alerts_processed")).first()[:] == (15, 9, 2)
    # every poll that wrote facts is committed; readers see them all
    assert S.read_committed(spark, out, "trip_updates").count() == 9
    # rows written part-way, which no commit names, stay hidden
    C.stage(S.read_committed(spark, out, "trip_updates", with_run=True), out, "trip_updates")
    assert S.read_committed(spark, out, "trip_updates").count() == 9


def test_malformed_polls(spark, scratch):
    """A truncated poll, a word for a number, and a number too large for its column."""
    good = _stage(scratch, "trip", "ok.json", TRIP_POLL)
    adir = _stage(scratch, "alert", "a1.json", ALERT_POLL)
    stop = '{"entity":[{"id":"e","tripUpdate":{"trip":{"tripId":"t"},"delay":%s}}]}'
    broken = {"cut.json": json.dumps(TRIP_POLL)[:200], "word.json": stop % '"late"', "wide.json": stop % "99999999999"}
    for name, text in broken.items():
        one = os.path.join(scratch, "only-" + name)
        os.makedirs(one)
        for folder in (good, one):
            with open(os.path.join(folder, name), "w") as f:
                f.write(text)
        polls = R.read_poll_files(spark, one, "trip-update")
        alerts = R.read_poll_files(spark, adir, "alert")
        with pytest.raises(R.InvalidFeedRows, match="malformed"):
            R.flatten(polls, alerts, on_invalid="strict")
        rejected = R.flatten(polls, alerts, on_invalid="quarantine")["rejected"].collect()
        assert [(r.table_name, r.row_json) for r in rejected] == [("polls", text)]
    with pytest.raises(Exception, match="malformed"):
        _ingest(spark, scratch, good, adir, os.path.join(scratch, "strict"), "ck1")
    assert not os.path.exists(os.path.join(scratch, "strict", "trip_updates"))
    out = os.path.join(scratch, "quarantine")
    _ingest(spark, scratch, good, adir, out, "ck2", on_invalid="quarantine")
    assert S.read_committed(spark, out, "trip_updates").count() == 3
    assert {r.row_json for r in S.read_committed(spark, out, "rejected").collect()} == set(broken.values())


def test_overlong_values(spark, scratch):
    poll = {"entity": [{"id": "e1", "tripUpdate": {"trip": {"tripId": "t1", "startDate": "2024-01-05"}}},
                       {"id": "e2", "tripUpdate": {"trip": {"tripId": "t2", "startDate": "20240105"}}}]}
    polls = R.read_poll_files(spark, _stage(scratch, "trip", "p.json", poll), "trip-update")
    alerts = R.read_poll_files(spark, _stage(scratch, "alert", "a.json", {"entity": []}), "alert")
    with pytest.raises(R.InvalidFeedRows, match="start_date is wider than 8"):
        R.flatten(polls, alerts, on_invalid="strict")
    q = R.flatten(polls, alerts, on_invalid="quarantine")
    assert [r.entity_id for r in q["trip_updates"].collect()] == ["e2"]
    assert [r.reason for r in q["rejected"].collect()] == ["start_date is wider than 8"]


def test_json_lines_keep_polls_apart(spark, scratch):
    """Polls of one file without a header time, with equal entity ids and positions."""
    d = os.path.join(scratch, "lines")
    os.makedirs(d)
    polls = [{"entity": [{"id": "e", "tripUpdate": {"trip": {"tripId": t}}}]} for t in ("a", "b", "b")]
    with open(os.path.join(d, "p.jsonl"), "w") as f:
        f.write("".join(json.dumps(p) + "\n" for p in polls))
    got = R.trip_updates(R.entities(R.read_poll_files(spark, d, "trip-update", one_poll_per_file=False))).collect()
    assert sorted(r.trip_id for r in got) == ["a", "b"]  # a line repeated word for word is one poll
    assert len({r.update_pk for r in got}) == 2


def test_times_do_not_depend_on_the_session_zone(spark, scratch):
    tdir = _stage(scratch, "trip", "p1.json", {**TRIP_POLL, "header": {"timestamp": 1704441600}})
    spark.conf.set("spark.sql.session.timeZone", "Europe/Brussels")
    try:
        polls = R.read_poll_files(spark, tdir, "trip-update")
        got = R.trip_updates(R.entities(polls)).filter("trip_id = 't2'").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got.update_timestamp == got.fetched_at == dt.datetime(2024, 1, 5, 8, 0)


def _midnight(scratch):
    """One trip polled at 23:50 and, later and with a newer state, at 00:10."""
    for name, stamp, delay in (("p1.json", 1704498600, 60), ("p2.json", 1704499800, 120)):
        trip = {"trip": {"tripId": "t1", "startDate": "20240105"}, "timestamp": stamp, "delay": delay}
        d = _stage(scratch, name[:2], name, {"header": {"timestamp": stamp}, "entity": [{"id": "e", "tripUpdate": trip}]})
        _stage(scratch, "both", name, {"header": {"timestamp": stamp}, "entity": [{"id": "e", "tripUpdate": trip}]})
    return os.path.dirname(d)


def test_latest_across_midnight(spark, scratch):
    root = _midnight(scratch)
    table = os.path.join(scratch, "latest")
    for k, sub in enumerate(("p1", "p2")):
        q = S.start_latest_table(spark, os.path.join(root, sub), table, checkpoint=os.path.join(scratch, f"ck{k}"))
        q.awaitTermination(120)
    rows = spark.read.parquet(table).collect()
    assert [(r.trip_id, r.overall_delay, str(r.service_day)) for r in rows] == [("t1", 120, "2024-01-05")]
    stream = S.latest_state_stream(S.trip_updates_stream(spark, os.path.join(root, "both")))
    name = "midnight_" + os.path.basename(scratch).replace("-", "_")
    q = (stream.writeStream.outputMode("update").format("memory").queryName(name)
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.table(name).collect()
    assert [(r.trip_id, r.overall_delay, r.snapshots) for r in got] == [("t1", 120, 2)]


def test_latest_state_stream(spark, scratch):
    tdir = _stage(scratch, "trip", "p1.json", TRIP_POLL)
    _stage(scratch, "trip", "p2.json", _second_poll())
    stream = S.latest_state_stream(S.trip_updates_stream(spark, tdir))
    name = "latest_" + os.path.basename(scratch).replace("-", "_")
    q = (stream.writeStream.outputMode("update").format("memory").queryName(name)
         .option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.table(name)
    latest = (got.groupBy("trip_id").agg(F.max("update_timestamp").alias("ts"),
                                         F.max("snapshots").alias("n")).collect())
    by = {r.trip_id: r for r in latest}
    assert by["t1"].n == 2 and by["t1"].ts.second == 16  # the newer one: 2^32 s
    assert by["t2"].n == 2


def test_latest_table_upsert_across_batches(spark, scratch):
    tdir = _stage(scratch, "trip", "p1.json", TRIP_POLL)
    table = os.path.join(scratch, "latest")
    q = S.start_latest_table(spark, tdir, table, checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    first = {r.trip_id: r for r in spark.read.parquet(table).collect()}
    assert set(first) == {"t1", "t2", "t5"} and first["t1"].overall_delay == 60
    # a later poll arrives: only the newer snapshot of t1 replaces the old one
    _stage(scratch, "trip", "p2.json", _second_poll())
    q = S.start_latest_table(spark, tdir, table, checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    rows = spark.read.parquet(table).collect()
    by = {r.trip_id: r for r in rows}
    assert len(rows) == 3 and by["t1"].overall_delay == 120
    assert by["t1"].update_timestamp.second == 16  # 2^32 s, the newer one
