"""SNK-1 static load and SNK-3 dimension seed, end to end on a hand-built feed."""

import os

import pytest

from tramline.plans import loads as L
from tramline.sources.sinks import CheckFailed, current_version, read_published
from tests.test_gtfs_reader import ROUTES, STOP_TIMES, STOPS, TRIPS, _write

CALENDAR = ("service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,"
            "start_date,end_date\nsvc1,0,0,0,0,0,0,0,20240101,20241231\n")
CALENDAR_DATES = "service_id,date,exception_type\nsvc1,20240102,1\nsvc1,20240103,1\n"
TRANSFERS = "from_stop_id,to_stop_id,transfer_type,min_transfer_time\n8813003,8892007,2,300\n"
TRANSLATIONS = ("table_name,field_name,field_value,language,translation\n"
                "stops,stop_name,Gent-Sint-Pieters,fr,Gand-Saint-Pierre\n")


def _feed(folder, trips=TRIPS):
    for name, text in [("stops", STOPS), ("routes", ROUTES), ("trips", trips),
                       ("stop_times", STOP_TIMES), ("calendar", CALENDAR),
                       ("calendar_dates", CALENDAR_DATES), ("transfers", TRANSFERS),
                       ("translations", TRANSLATIONS)]:
        _write(folder, f"{name}.txt", text)
    return folder


def test_static_load_checks_then_publishes(spark, scratch):
    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    _feed(feed)
    out = os.path.join(scratch, "wh")
    # trips.txt has a NULL route_id (t4) and stops.txt a blank-but-present name:
    # NOT NULL on trips.route_id aborts the publish; nothing is written.
    with pytest.raises(CheckFailed, match="trips.route_id"):
        L.load_static_feed(spark, feed, out)
    assert current_version(spark, out) is None and os.listdir(out) == []
    # the same feed with its NOT NULL breaks repaired publishes in full
    _write(feed, "trips.txt", TRIPS.replace(",svc1,t4,Nowhere,,,,\n", "")
           .replace("r2,,t2", "r2,svc1,t2"))
    _write(feed, "routes.txt", ROUTES.replace("r3,A,L 12,,,,", "r3,A,L 12,,2,,"))
    paths = L.load_static_feed(spark, feed, out)
    assert list(paths) == ["routes", "calendar", "stops", "calendar_dates", "trips",
                           "stop_times", "transfers", "translations"]
    assert spark.read.parquet(paths["trips"]).count() == 3
    with pytest.raises(CheckFailed, match="orphans"):  # rX has no route; enforced on request
        L.load_static_feed(spark, feed, os.path.join(scratch, "wh2"), enforce_fk=True)


def test_load_dimensions_drops_orphans(spark, scratch):
    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    _feed(feed)
    out = os.path.join(scratch, "dims")
    paths, counts = L.load_dimensions(spark, feed, out)
    assert read_published(spark, out, "dim_trips").count() == 2
    c = counts.first()
    assert (c.kept, c.rejected) == (2, 2)
    # duplicate and missing keys are refused as the warehouse's constraints do; the old version stays
    before = current_version(spark, out)
    _write(feed, "stops.txt", STOPS + STOPS.split("\n")[1] + "\n" + ",No id,1,1,1,,,,\n")
    with pytest.raises(CheckFailed, match="dim_stations.stop_id: 1 NULL.*duplicate primary key"):
        L.load_dimensions(spark, feed, out)
    assert current_version(spark, out) == before
    assert [x.split("-")[0] for x in sorted(os.listdir(out))] == ["_manifest", f"version={before}"]
    # columns that a feed leaves out count as blank
    _write(feed, "stops.txt", "stop_id,stop_name\ns1,One\n")
    _write(feed, "routes.txt", "route_id\nr1\n")
    _write(feed, "trips.txt", "trip_id,route_id\nt1,r1\n")
    L.load_dimensions(spark, feed, out)
    assert tuple(read_published(spark, out, "dim_stations").first()) == ("s1", "One", None, None, None)
    assert tuple(read_published(spark, out, "dim_routes").first()) == ("r1", None, None, None, 2)
    assert tuple(read_published(spark, out, "dim_trips").first()) == ("t1", "r1", "UNKNOWN", None, None, None)
    os.remove(os.path.join(feed, "routes.txt"))
    with pytest.raises(FileNotFoundError):
        L.load_dimensions(spark, feed, os.path.join(scratch, "dims2"))


def test_lenient_load_reports_what_it_lost(spark, scratch):
    feed = os.path.join(scratch, "feed")
    os.makedirs(feed)
    _feed(feed, TRIPS.replace(",svc1,t4,Nowhere,,,,\n", "").replace("r2,,t2", "r2,svc1,t2"))
    _write(feed, "routes.txt", ROUTES.replace("r3,A,L 12,,,,", "r3,A,L 12,,2,,"))
    _write(feed, "calendar_dates.txt", CALENDAR_DATES + "svc1,20240104,often\nsvc1,20240105,\n")  # needed: the row goes
    _write(feed, "transfers.txt", TRANSFERS + "8892007,8892007,3,soon\n8892007,8813003,2,60\n")       # not needed: NULL
    with pytest.raises(Exception, match="often|soon|CAST_INVALID_INPUT"):
        L.load_static_feed(spark, feed, os.path.join(scratch, "strict"))
    _write(feed, "calendar_dates.txt", CALENDAR_DATES + "svc1,20240104,often\n")
    paths = L.load_static_feed(spark, feed, os.path.join(scratch, "wh"), strict=False)
    bad = spark.read.parquet(paths["bad_values"]).collect()
    assert sorted((r.table_name, r.column_name, r.value, r.kept) for r in bad) == [
        ("calendar_dates", "exception_type", "often", False), ("transfers", "min_transfer_time", "soon", True)]
    assert all(r.value in r.row_text for r in bad)
    assert spark.read.parquet(paths["calendar_dates"]).count() + sum(not r.kept for r in bad) == 3
    times = sorted(map(str, (r.min_transfer_time for r in spark.read.parquet(paths["transfers"]).collect())))
    assert times == ["300", "60", "None"]
