"""Property tests: shares sum to 100, kept + rejected = input,
flatten(nest(rows)) = rows, at most one latest timestamp per trip."""

import json
import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tramline.operators import realtime as R
from tramline.operators.aggregates import share_of_total_window
from tramline.operators.joins import split_orphans
from tramline.plans.punctuality import latest_updates

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.integers(min_value=1, max_value=10_000), min_size=1, max_size=6))
def test_shares_sum_to_100(spark, counts):
    g = spark.createDataFrame([(str(i), c) for i, c in enumerate(counts)], "k string, n long")
    pct = [r.pct for r in share_of_total_window(g, "n", "pct").collect()]
    assert abs(sum(pct) - 100.0) <= 0.005 * len(counts) + 1e-9


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "x"])), max_size=20))
def test_kept_plus_rejected_is_input(spark, refs):
    child = spark.createDataFrame([(i, r) for i, r in enumerate(refs)], "id int, ref string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "key string")
    kept, rejected = split_orphans(child, parent, "ref", "key")
    k = {r.id for r in kept.collect()}
    j = {r.id for r in rejected.collect()}
    assert k.isdisjoint(j) and k | j == set(range(len(refs)))
    assert all(refs[i] in ("a", "b") for i in k)


stop_rows = st.lists(st.tuples(st.integers(0, 5), st.integers(1, 30),
                               st.one_of(st.none(), st.integers(-300, 900))),
                     min_size=1, max_size=25)


@SETTINGS
@given(stop_rows)
def test_flatten_of_nested_poll_gives_back_the_rows(spark, rows):
    # nest: group (trip, seq, delay) rows into one poll, write it, flatten it back
    ents = {}
    for trip, seq, delay in rows:
        stu = {"stopSequence": seq, "stopId": f"s{seq}"}
        if delay is not None:
            stu["arrival"] = {"delay": delay}
        ents.setdefault(trip, []).append(stu)
    poll = {"entity": [{"id": f"e{t}", "tripUpdate": {"trip": {"tripId": f"t{t}"},
                                                      "stopTimeUpdate": s}}
                       for t, s in ents.items()]}
    d = tempfile.mkdtemp(prefix="tramline-prop-", dir="/tmp")
    with open(os.path.join(d, "p.json"), "w") as f:
        json.dump(poll, f)
    kept = R.trip_update_entities(R.entities(R.read_poll_files(spark, d, "trip-update")))
    out = R.trip_stop_updates(kept, carry={"trip_id": "entity.tripUpdate.trip.tripId"})
    def key(t):  # NULL delays sort first without comparing None with int
        return (t[0], t[1], t[2] is not None, t[2] if t[2] is not None else 0)

    got = sorted(((r.trip_id, r.stop_sequence, r.arrival_delay) for r in out.collect()), key=key)
    want = sorted(((f"t{t}", s, dl) for t, s, dl in rows), key=key)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["t1", "t2", "t3"]), st.integers(0, 5)),
                min_size=1, max_size=20))
def test_latest_keeps_only_the_max_timestamp_per_trip(spark, snaps):
    df = spark.createDataFrame([(i, t, ts) for i, (t, ts) in enumerate(snaps)],
                               "update_pk int, trip_id string, update_timestamp int")
    latest = latest_updates(df)
    per_trip = latest.groupBy("trip_id").agg(F.count_distinct("update_timestamp").alias("n"),
                                             F.max("update_timestamp").alias("m")).collect()
    want = {}
    for t, ts in snaps:
        want[t] = max(want.get(t, ts), ts)
    assert {r.trip_id: r.m for r in per_trip} == want
    assert all(r.n == 1 for r in per_trip)
    # ties are all kept
    assert latest.count() == sum(1 for t, ts in snaps if ts == want[t])


@SETTINGS
@given(st.lists(st.integers(min_value=-(2 ** 63), max_value=2 ** 63 - 1), min_size=1,
                max_size=20))
def test_decode_long_roundtrip(spark, values):
    from tramline.functions.timecols import decode_long

    def obj(v):
        low = v & 0xFFFFFFFF
        low = low - 2 ** 32 if low >= 2 ** 31 else low   # protobuf Long: signed 32-bit parts
        return json.dumps({"low": low, "high": v >> 32, "unsigned": False})

    rows = [(obj(v), str(v), v) for v in values]
    df = spark.createDataFrame(rows, "o string, n string, v long")
    got = df.select(decode_long("o").alias("a"), decode_long("n").alias("b"), "v").collect()
    assert all(r.a == r.v and r.b == r.v for r in got)


def test_latest_by_trip_or_by_trip_and_day(spark):
    # T-8: keyed by trip only (the reference), a multi-day log keeps one day;
    # adding start_date keeps the latest snapshot of each day.
    df = spark.createDataFrame(
        [(1, "t1", "20240101", 10), (2, "t1", "20240101", 20),
         (3, "t1", "20240102", 5), (4, "t1", "20240102", 7)],
        "update_pk int, trip_id string, start_date string, update_timestamp int")
    assert sorted(r.update_pk for r in latest_updates(df).collect()) == [2]
    both = latest_updates(df, ("trip_id", "start_date")).collect()
    assert sorted(r.update_pk for r in both) == [2, 4]


_ALPHABET = "ab Z9\t\n\r\x0b\x0c\xa0 　​:-é"


@SETTINGS
@given(st.lists(st.text(alphabet=_ALPHABET, max_size=8), min_size=1, max_size=20),
       st.integers(min_value=1, max_value=5))
def test_clean_text_matches_python_strip(spark, values, width):
    from tramline.functions.text import clean_text

    def model(v):  # the loader's rule: strip, blank -> None, truncate by characters
        s = v.strip()
        return s[:width] if s else None

    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(clean_text("v", width)).collect()]
    assert got == [model(v) for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 70), st.integers(0, 70),
                          st.booleans()), min_size=1, max_size=20))
def test_hour_of_text_time_rule(spark, parts):
    from tramline.functions.timecols import hour_of_text_time

    def text(h, m, s, pad):
        return (f"{h:02d}" if pad else str(h)) + f":{m:02d}:{s:02d}"

    def model(t):  # two-digit hour 00-24, minutes and seconds 00-59
        hh, mm, ss = t.split(":")
        ok = len(hh) == 2 and int(hh) <= 24 and int(mm) <= 59 and int(ss) <= 59
        return hh if ok else None

    texts = [text(*p) for p in parts]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in df.select(hour_of_text_time("v")).collect()] == [model(t) for t in texts]
