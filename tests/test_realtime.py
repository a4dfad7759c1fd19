"""GTFS-RT flattening on hand-written poll files (edge payloads, T-1, T-2, T-3)."""

import datetime as dt
import json
import os

import pytest

from tramline.operators import realtime as R

TRIP_POLL = {"entity": [
    {"id": "e1", "tripUpdate": {
        "trip": {"tripId": "t1", "routeId": "r1", "startDate": "20240105",
                 "startTime": "08:00:00", "scheduleRelationship": 0},
        "vehicle": {"id": "v1", "label": "IC 512", "licensePlate": "P1"},
        "delay": 60,
        "timestamp": {"low": -1, "high": 0, "unsigned": False},
        "stopTimeUpdate": [
            {"stopSequence": 1, "stopId": "8813003", "arrival": {"time": 0, "delay": 30},
             "departure": {"time": {"low": 1704441600, "high": 0}, "delay": 45}},
            {"stopId": "8892007", "departure": {"time": "1704445200"}},
        ]}},
    {"id": "e2", "tripUpdate": {"trip": {"tripId": "t2"}, "timestamp": 1704441600,
                                "stopTimeUpdate": [{"stopSequence": 4, "stopId": "111"}]}},
    {"id": "e3", "tripUpdate": {}},
    {"id": "e4"},
    {"id": "e5", "tripUpdate": {"trip": {"tripId": "t5"}, "timestamp": 1704441600}},
]}
ALERT_POLL = {"entity": [
    {"id": "a1", "alert": {
        "cause": 3, "effect": 4, "activePeriod": [],
        "headerText": {"translation": [{"language": "fr", "text": "Retard"},
                                       {"language": "nl", "text": "Vertraging"}]},
        "descriptionText": {"translation": [{"language": "en", "text": "Delay"}]},
        "informedEntity": [{"agencyId": "AG1", "routeId": "r1",
                            "trip": {"tripId": "t1", "startDate": "20240105"}},
                           {"stopId": "8813003"}]}},
    {"id": "a2", "alert": {"activePeriod": [{"start": 1704441600,
                                             "end": {"low": 1704445200, "high": 0}}]}},
    {"id": "a3", "alert": {}},
]}


def _stage(folder, sub, name, payload):
    d = os.path.join(folder, sub)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        json.dump(payload, f, indent=1)  # multi-line documents, like a real poll file
    return d


@pytest.fixture()
def polls(spark, scratch):
    tdir = _stage(scratch, "trip", "p1.json", TRIP_POLL)
    _stage(scratch, "trip", "p2.json", {"header": {"gtfsRealtimeVersion": "2.0"}})  # no entity
    adir = _stage(scratch, "alert", "a1.json", ALERT_POLL)
    return (R.read_poll_files(spark, tdir, "trip-update"),
            R.read_poll_files(spark, adir, "alert"))


def test_entities_and_kinds(polls):
    trips, alerts = polls
    ents = R.entities(trips)
    assert ents.count() == 5  # the poll without 'entity' gives no rows
    kinds = {r.entity.id: r.kind for r in R.entity_kind(ents).collect()}
    assert kinds == {"e1": "trip_update", "e2": "trip_update", "e3": "none", "e4": "none",
                     "e5": "trip_update"}
    a = R.alert_entities(R.entities(alerts))
    assert sorted(r.entity.id for r in a.collect()) == ["a1", "a2"]  # {} is absent


def test_trip_headers_and_stops(polls):
    trips, _ = polls
    kept = R.trip_update_entities(R.entities(trips))
    heads = {r.entity_id: r for r in R.trip_updates(kept).collect()}
    assert set(heads) == {"e1", "e2", "e5"}
    assert heads["e1"].update_timestamp == dt.datetime(2106, 2, 7, 6, 28, 15)  # low=-1 -> 2^32-1
    assert heads["e1"].vehicle_label == "IC 512" and heads["e1"].overall_delay == 60
    stops = R.trip_stop_updates(kept, carry={"entity_id": "entity.id"}).collect()
    by = {(r.entity_id, r.stop_id): r for r in stops}
    assert len(stops) == 3  # e5 has a header and no stop rows
    s1 = by[("e1", "8813003")]
    assert s1.arrival_time == dt.datetime(1970, 1, 1)  # epoch 0 is not NULL
    assert s1.departure_time == dt.datetime(2024, 1, 5, 8, 0)
    s2 = by[("e1", "8892007")]
    assert s2.stop_sequence == 0 and s2.arrival_time is None and s2.arrival_delay is None
    # keys: every child points at its parent; child ids unique
    pk = {r.update_pk for r in R.trip_updates(kept).collect()}
    assert {r.update_pk for r in stops} <= pk and len({r.id for r in stops}) == 3


def test_keys_are_stable_on_replay(spark, polls):
    trips, _ = polls
    k1 = sorted(r.update_pk for r in R.trip_updates(R.entities(trips)).collect())
    k2 = sorted(r.update_pk for r in R.trip_updates(R.entities(trips)).collect())
    assert k1 == k2


def test_alert_children(polls):
    _, alerts = polls
    a = R.alert_entities(R.entities(alerts))
    texts = R.alert_texts(a, carry={"entity_id": "entity.id"}).collect()
    assert sorted((r.entity_id, r.field_name, r.language) for r in texts) == [
        ("a1", "description", "en"), ("a1", "header", "fr"), ("a1", "header", "nl")]
    periods = R.alert_active_periods(a, carry={"entity_id": "entity.id"}).collect()
    assert [(p.entity_id, p.period_start, p.period_end) for p in periods] == [
        ("a2", dt.datetime(2024, 1, 5, 8, 0), dt.datetime(2024, 1, 5, 9, 0))]
    inf = R.alert_informed_entities(a).collect()
    assert {(r.route_id, r.trip_id, r.stop_id) for r in inf} == {
        (None, None, "8813003"), ("r1", "t1", None)}


@pytest.fixture()
def stations(spark):
    return spark.createDataFrame(
        [("8813003", "Brussel-Centraal / Bruxelles-Central"), ("8892007", "Gent-Sint-Pieters"),
         ("111", "Liège-Guillemins")], "stop_id string, stop_name string")


def test_station_filter_any_stop_keeps_all_stops(polls, stations):
    trips, _ = polls
    ents = R.trip_update_entities(R.entities(trips))
    ids = R.resolve_station_ids(stations, "Gent")
    kept = R.filter_trips_by_stations(ents, ids)
    stops = R.trip_stop_updates(kept).collect()
    # T-2: the trip matched via Gent keeps its Brussels stop as well
    assert sorted(r.stop_id for r in stops) == ["8813003", "8892007"]


def test_station_filter_no_match_means_whole_network(polls, stations):
    trips, _ = polls
    ents = R.trip_update_entities(R.entities(trips))
    ids = R.resolve_station_ids(stations, "Antwerpen")
    assert ids.count() == 0
    assert R.filter_trips_by_stations(ents, ids).count() == 3  # T-1
    assert R.filter_trips_by_stations(ents, ids, on_no_match="none").count() == 0
    assert R.resolve_station_ids(stations, "") is None
    digits = R.resolve_station_ids(stations, " 111 ")
    assert [r.stop_id for r in digits.collect()] == ["111"]
    assert R.filter_trips_by_stations(ents, digits).count() == 1


def test_flatten_and_summary(polls, stations):
    trips, alerts = polls
    out = R.flatten(trips, alerts, stations, "Bruxelles")
    s = out["summary"].first().asDict()
    assert s == {"station_filter": "Bruxelles", "status": "ok", "resolved_stop_ids_count": 1,
                 "total_trips_fetched": 5, "trips_inserted": 1, "alerts_processed": 2}
    s2 = R.flatten(trips, alerts)["summary"].first()
    assert s2.station_filter == "None (Full Network)" and s2.trips_inserted == 3
    assert s2.resolved_stop_ids_count == 0


def test_missing_stop_id_strict_and_quarantine(spark, scratch):
    # T-3: a stop without stopId breaks NOT NULL; strict refuses the poll,
    # quarantine keeps the good rows and diverts the bad one.
    poll = {"entity": [{"id": "x1", "tripUpdate": {"trip": {"tripId": "t9"},
                        "stopTimeUpdate": [{"stopSequence": 1, "stopId": "A"},
                                           {"stopSequence": 2}]}}]}
    tdir = _stage(scratch, "trip", "p.json", poll)
    adir = _stage(scratch, "alert", "a.json", {"entity": []})
    trips = R.read_poll_files(spark, tdir, "trip-update")
    alerts = R.read_poll_files(spark, adir, "alert")
    with pytest.raises(R.InvalidFeedRows):
        R.flatten(trips, alerts, on_invalid="strict")
    q = R.flatten(trips, alerts, on_invalid="quarantine")
    assert [r.stop_id for r in q["trip_stop_updates"].collect()] == ["A"]
    rej = q["rejected"].collect()
    assert len(rej) == 1 and rej[0].table_name == "trip_stop_updates"
    assert rej[0].reason == "stop_id is null"
    assert R.flatten(trips, alerts)["trip_stop_updates"].count() == 2  # keep


def test_duplicate_alert_in_one_poll(spark, scratch):
    # CHK-4: (entity_id, fetched_at) is unique; the same alert twice in one poll
    poll = {"header": {"timestamp": 1704441600}, "entity": [
        {"id": "a1", "alert": {"cause": 1, "headerText": {"translation": [{"text": "x"}]}}},
        {"id": "a1", "alert": {"cause": 2, "headerText": {"translation": [{"text": "y"}]}}},
        {"id": "a2", "alert": {"cause": 3}}]}
    tdir = _stage(scratch, "trip", "t.json", {"entity": []})
    adir = _stage(scratch, "alert", "a.json", poll)
    trips = R.read_poll_files(spark, tdir, "trip-update")
    alerts = R.read_poll_files(spark, adir, "alert")
    with pytest.raises(R.InvalidFeedRows):
        R.flatten(trips, alerts, on_invalid="strict")
    q = R.flatten(trips, alerts, on_invalid="quarantine")
    kept = q["service_alerts"].collect()
    assert sorted(r.entity_id for r in kept) == ["a1", "a2"]
    kept_pk = {r.alert_pk for r in kept}
    assert {r.alert_pk for r in q["alert_texts"].collect()} <= kept_pk  # no orphan texts
    assert q["alert_texts"].count() == 1
    reasons = sorted(r.reason for r in q["rejected"].collect())
    assert reasons == ["duplicate (entity_id, fetched_at)", "parent alert diverted"]


def _parses(df):
    """How often the plan parses poll texts."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


@pytest.fixture()
def parsed(spark):
    """Three polls: trips A (stops 1, 2), B (no stops), C (3, a stop without id, 3); D (2); alerts only."""
    def trip(i, *stops):
        return {"id": i, "tripUpdate": {"trip": {"tripId": i}, "stopTimeUpdate": [{"stopId": s} if s else {} for s in stops]}}
    feeds = [[trip("A", "1", "2"), {"id": "B", "tripUpdate": {"trip": {"tripId": "B"}}}, trip("C", "3", None, "3")],
             [trip("D", "2"), {"id": "E"}], [{"id": "a", "alert": {"cause": 1}}]]
    rows = [("f", f"p{i}", dt.datetime(2024, 1, 1, i), json.dumps({"entity": e})) for i, e in enumerate(feeds)]
    return R.parse_polls(spark.createDataFrame(rows, "feed string, source_file string, fetched_at timestamp_ntz, payload string"))


def _ids(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "stop_id string")


def test_entities_parse_each_poll_once(parsed):
    ents = R.entities(parsed)
    assert sorted(r.id for r in ents.select("entity.id").collect()) == ["A", "B", "C", "D", "E", "a"]
    assert _parses(ents) == 1


def test_station_filter_parses_once_a_side_and_sorts_no_entities(spark, parsed):
    trips = R.trip_update_entities(R.entities(parsed))

    def kept(*ids, **kw):
        return sorted(r.id for r in R.filter_trips_by_stations(trips, _ids(spark, *ids), **kw).select("entity.id").collect())
    assert kept("2", "2", "3") == ["A", "C", "D"]  # repeated ids, repeated stops, a stop without id
    assert kept("1", None, "") == ["A"]
    assert kept("9") == [] and kept() == ["A", "B", "C", "D"]  # T-1: no id at all means no filter
    assert kept(on_no_match="none") == []
    df = R.filter_trips_by_stations(trips, _ids(spark, "2"))
    assert _parses(df) == 2
    assert "ShuffledHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def _small_feed_tables(spark, scratch, lines):
    """orders 1 to 3, their lines, and conversations 7 (all three roles) and 8, as a query reads them."""
    from tramline.sources.tables import SCHEMAS
    day = dt.datetime(2024, 1, 5)
    for name, rows in {
        "orders": [(k, 10 + k, "O", 1.0, day, "1-URGENT") for k in (1, 2, 3)],
        "lineitem": [(k, 5, s, n, 1.0, 1.0, 0.0, 0.0, "N", "O", day) for k, s, n in lines],
        "conversations": [(7, 0, "user", "a"), (7, 1, "assistant", "b"), (7, 2, "system", "c"), (8, 0, "tool", "d")],
    }.items():
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(os.path.join(scratch, f"{name}.parquet"))
    return scratch


@pytest.mark.parametrize("lines", [[(1, 4, 1), (1, 4, 2), (2, 11, 1), (9, 4, 1)], []])
def test_surrogate_keys_parse_each_feed_once_a_table(spark, scratch, lines):
    from tramline.plans.catalog_realtime import surrogate_keys
    df = surrogate_keys(spark, _small_feed_tables(spark, scratch, lines))
    stops = sum(k < 9 for k, _, _ in lines)  # the line of an order that is not there gives no stop
    assert df.first().asDict() == {
        "trip_updates": 3, "distinct_update_pk": 3, "stop_updates": stops, "distinct_stop_ids": stops, "orphan_stop_updates": 0,
        "alerts": 2, "alert_texts": 3, "distinct_text_ids": 3}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("posexplode(") - plan.count("posexplode(coalesce(") <= 3  # children: stops once, texts in one subquery


def test_summary_counts_in_one_pass_over_the_trip_feed(spark, parsed):
    ents = R.entities(parsed)
    alerts = R.alert_entities(ents)

    def counts(ids, **kw):
        rows = R.ingest_summary(ents, alerts, "x", _ids(spark, *ids), **kw).collect()
        return sorted((*(r[c] for c in kw.get("by", ())), r.resolved_stop_ids_count, r.total_trips_fetched, r.trips_inserted,
                       r.alerts_processed) for r in rows)
    assert counts(["2", "3"]) == [(2, 6, 3, 1)]
    assert counts(["9"]) == [(1, 6, 0, 1)]
    assert counts([]) == [(0, 6, 4, 1)] and counts([], on_no_match="none") == [(0, 6, 0, 1)]
    assert counts(["2", "2", None]) == [(3, 6, 2, 1)]
    hours = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    assert counts(["2"], by=["fetched_at"]) == [(hours[0], 1, 3, 1, 0), (hours[1], 1, 2, 1, 0), (hours[2], 1, 1, 0, 1)]
    assert _parses(R.ingest_summary(ents, alerts, "x", _ids(spark, "2"))) == 2  # one for the trips, one for the alerts
