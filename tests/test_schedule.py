"""Q1–Q5 building blocks on hand-built GTFS tables, with the reference's traps."""

import pytest

from tramline.plans import schedule as S
from tramline.sources.gtfs import project_to_schema
from tramline.sources.schemas import GTFS_TABLES


def _table(spark, name, rows):
    cols = [c for c, _ in GTFS_TABLES[name]]
    raw = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) +
                                 (None,) * (len(cols) - len(r)) for r in rows],
                                ", ".join(f"{c} string" for c in cols))
    return project_to_schema(raw, GTFS_TABLES[name])


@pytest.fixture()
def feed(spark):
    routes = _table(spark, "routes", [
        ("r1", "A", "IC-01", "Eupen -- Oostende", 2), ("r2", "A", "S1", "", 2),
        ("r3", "A", "B12", "Bus", 3), ("r4", "A", "L9", "no trips", 2)])
    trips = _table(spark, "trips", [
        ("r1", "s1", "t1", "Anvers-Central", None, 1, 0),
        ("r1", "s1", "t2", "Anvers-Central", None, 2, 1),
        ("r2", "s2", "t3", "Bruxelles-Midi", None, None, 0),
        ("r3", "s3", "t4", "Louvain", None, 1, 1)])
    stop_times = _table(spark, "stop_times", [
        ("t1", "09:55:00", "10:00:00", None, None, "p1", 1),
        ("t1", "10:30:00", "10:31:00", None, None, "p2", 2),
        ("t2", "25:10:00", "25:10:00", None, None, "p1", 1),   # past midnight: NULL hour
        ("t2", "24:05:00", "24:05:00", None, None, "p3", 2),   # '24' is an hour
        ("t3", "9:05:00", "9:05:00", None, None, "p2", 1),     # one-digit hour: NULL
        ("t3", "08:00:00", "08:00:00", None, None, "p2", 1),   # repeated first sequence
        ("t4", "10:10:00", "10:10:00", None, None, "p1", 1)])  # bus, not rail
    stops = _table(spark, "stops", [
        ("st1", "Bruxelles-Central", 50.8, 4.3, 1, None, None),
        ("p1", "Bruxelles-Central", 50.8, 4.3, 0, "st1", "3"),
        ("p2", "Bruxelles-Central", 50.8, 4.3, 0, "st1", "4"),
        ("p3", "Gent", 51.0, 3.7, 0, "st2", "1"),
        ("st2", "Gent", 51.0, 3.7, 1, None, None)])
    return routes, trips, stop_times, stops


def test_q1_rail_only_and_text_hours(feed):
    routes, trips, st, _ = feed
    got = [tuple(r) for r in S.peak_departure_hours(st, trips, routes, k=10).collect()]
    # t4 is a bus; 25:10 and 9:05 fall into the NULL group; 24:05 stays '24'
    assert sorted(got, key=str) == sorted([("10", 2), (None, 2), ("24", 1), ("08", 1)], key=str)


def test_q2_platforms_of_matching_station(feed):
    _, _, st, stops = feed
    got = [tuple(r) for r in S.busiest_platforms(st, stops, "bruxelles-central").collect()]
    assert got == [("3", 3), ("4", 3)]  # ties broken by platform code


def test_q3_first_stop_before_noon(feed):
    routes, trips, st, _ = feed
    first = {r.trip_id: (r.first_stop_sequence, r.first_departure_time)
             for r in S.first_stop_per_trip(st).collect()}
    # T-6: t3 repeats sequence 1; the earliest text departure of that sequence wins
    assert first["t3"] == (1, "08:00:00")
    got = [tuple(r) for r in S.morning_destinations(trips, st).collect()]
    # t2's first stop is 25:10 (not before noon); '9:05:00' < '12:00:00' is false as text
    assert got == [("Anvers-Central", 1), ("Bruxelles-Midi", 1), ("Louvain", 1)]


def test_q3_null_departure_does_not_hide_a_morning_row(spark):
    st = spark.createDataFrame([("t", 1, None), ("t", 1, "07:00:00")],
                               "trip_id string, stop_sequence int, departure_time string")
    r = S.first_stop_per_trip(st).first()
    assert (r.first_stop_sequence, r.first_departure_time) == (1, "07:00:00")


def test_q4_modal_days_ties_to_larger_and_epoch_weeks(spark):
    # service a: weeks with 5,5,2,2 days -> tie -> 5 (High); b: 3,1 -> tie -> 3 (Medium);
    # c: one day (Low). Dates straddle the year end inside one Monday-based week.
    rows = []
    def days(sid, start, n):
        import datetime as dt
        d0 = dt.date.fromisoformat(start)
        rows.extend((sid, (d0 + dt.timedelta(i)).strftime("%Y%m%d"), 1) for i in range(n))
    for wk in ("2024-01-01", "2024-01-08"):
        days("a", wk, 5)
    for wk in ("2024-01-15", "2024-01-22"):
        days("a", wk, 2)
    days("b", "2024-12-30", 3)          # Mon 30 Dec .. Wed 1 Jan: one week, not split
    days("b", "2025-01-13", 1)
    days("c", "2024-03-04", 1)
    rows.append(("c", "20241301", 2))   # removed date: ignored (exception_type 2)
    cd = spark.createDataFrame(rows, "service_id string, date string, exception_type int")
    typical = {r.service_id: r.typical_days_per_week
               for r in S.typical_days_per_week(cd).collect()}
    assert typical == {"a": 5, "b": 3, "c": 1}
    assert {r.service_id: r.typical_days_per_week
            for r in S.typical_days_per_week(cd, use_window=True).collect()} == typical
    got = {r.frequency_category: (r.service_count, r.percentage)
           for r in S.service_frequency(cd).collect()}
    assert got == {"High Frequency": (1, 33.33), "Medium Frequency": (1, 33.33),
                   "Low Frequency/Special": (1, 33.33)}
    general = {r.frequency_category: r.percentage
               for r in S.service_frequency(cd, window_total=False).collect()}
    assert general == {k: v[1] for k, v in got.items()}


def test_q5_amenities_routes_without_trips_vanish(feed):
    routes, trips, _, _ = feed
    rows = {r.route_id: r for r in S.accessibility(routes, trips).collect()}
    assert set(rows) == {"r1", "r2", "r3"}  # r4 has no trips
    r1 = rows["r1"]
    assert (r1.total_trips, r1.trips_with_bikes, r1.trips_with_wheelchair,
            r1.trips_with_any_amenity) == (2, 1, 1, 2)
    assert (r1.ratio_bikes, r1.percentage_any_amenity) == (0.5, 100.0)
    assert rows["r2"].trips_with_any_amenity == 0  # NULL bikes_allowed is not 1
    ranked = S.accessibility_ranked(routes, trips, k=2).collect()
    assert [r.route_id for r in ranked] == ["r2", "r1"]  # 0 % first; 100 % tie -> route_id
    assert [r.route_id for r in S.accessibility_sample(routes, trips, k=2).collect()] == [
        "r1", "r2"]


def test_frequency_classes_come_in_their_order(spark):
    """S-2: highest first, whatever the counts."""
    days = [("a", 1), ("b", 3), ("c", 3), ("d", 6)]
    rows = [(s, f"202401{1 + k:02d}", 1) for s, n in days for k in range(n)] + [("e", "20240102", 2)]
    got = [r.frequency_category for r in S.service_frequency(
        spark.createDataFrame(rows, "service_id string, date string, exception_type int")).collect()]
    assert got == ["High Frequency", "Medium Frequency", "Low Frequency/Special"]
