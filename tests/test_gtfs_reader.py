"""SRC-1/SRC-2/CLN-1/CLN-5/CLN-8 on hand-built GTFS text files (T-12 and loader traps)."""

import os

import pytest
from pyspark.sql import functions as F

from tramline.operators import dims as D
from tramline.operators import quality as Q
from tramline.sources import gtfs as G


def _write(folder, name, text, bom=True):
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(("\ufeff" if bom else "") + text)


STOPS = (
    'stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station,platform_code,stop_desc,wheelchair_boarding\n'
    '8813003,"Brussel-Centraal / Bruxelles-Central",50.8,4.3,1,,,,1\n'
    '8813003_3,"Brussel-Centraal / Bruxelles-Central",50.8,4.3,0,8813003,3,"say ""hi"", ok",\n'
    '\n'
    '8892007,"\tGent-Sint-Pieters  ",51.0,3.7,1,,,,x\n'
    '8000001,"  ",51.0,3.7,0,9999999,,\n'
)
ROUTES = (
    'route_id,agency_id,route_short_name,route_long_name,route_type,route_color,route_text_color\n'
    'r1,A,IC-01,Eupen -- Oostende,2,,\n'
    'r2,A,S1,,0,,\n'
    'r3,A,L 12,,,,\n'
)
TRIPS = (
    'route_id,service_id,trip_id,trip_headsign,block_id,bikes_allowed,wheelchair_accessible,trip_short_name\n'
    'r1,svc1,t1,Anvers-Central,,1,0,\n'
    'r2,,t2,Bruxelles-Midi,,2,1,\n'
    'rX,svc1,t3,Louvain,,,,\n'
    ',svc1,t4,Nowhere,,,,\n'
)
STOP_TIMES = (
    'trip_id,arrival_time,departure_time,drop_off_type,pickup_type,stop_id,stop_sequence\n'
    't1,08:00:00,08:01:00,,,8813003_3,1\n'
    't1,24:30:00,25:30:00,,,8892007,2\n'
)


@pytest.fixture()
def feed(scratch):
    _write(scratch, "stops.txt", STOPS)
    _write(scratch, "routes.txt", ROUTES)
    _write(scratch, "trips.txt", TRIPS, bom=False)
    _write(scratch, "stop_times.txt", STOP_TIMES)
    return scratch


def test_read_csv_text_bom_quotes_blank_and_short_rows(spark, feed):
    df = G.read_csv_text(spark, os.path.join(feed, "stops.txt"))
    assert df.columns[0] == "stop_id"  # BOM stripped
    rows = {r.stop_id: r for r in df.collect()}
    assert len(rows) == 4  # blank line skipped
    assert rows["8813003_3"].stop_desc == 'say "hi", ok'  # quoted comma + doubled quote
    assert rows["8000001"].wheelchair_boarding is None  # short row -> NULL
    assert all(isinstance(v, (str, type(None))) for r in rows.values() for v in r)


def test_read_feed_types_and_missing_file(spark, feed):
    tables = G.read_feed(spark, feed, ["routes", "stops", "trips", "stop_times"])
    r = {x.route_id: x for x in tables["routes"].collect()}
    assert r["r3"].route_type is None and r["r2"].route_type == 0
    assert dict(tables["stops"].dtypes)["stop_lat"] == "double"
    # stop_times keeps past-midnight text untouched
    st = tables["stop_times"].orderBy("stop_sequence").collect()
    assert st[1].departure_time == "25:30:00"
    with pytest.raises(G.MissingFeedFile):
        G.read_feed(spark, feed, ["routes", "calendar"])


def test_quoted_line_breaks_in_every_table(spark, scratch):
    _write(scratch, "trips.txt", 'route_id,service_id,trip_id,trip_headsign\nr1,s1,t1,"Gent\nSint"\n')
    _write(scratch, "stop_times.txt", 'trip_id,arrival_time,departure_time,stop_id,stop_sequence\n'
                                      't1,08:00:00,"08:01:00\n",s1,1\n')
    tables = G.read_feed(spark, scratch, ["trips", "stop_times"])
    assert [(r.trip_id, r.trip_headsign) for r in tables["trips"].collect()] == [("t1", "Gent\nSint")]
    assert [(r.trip_id, r.stop_id) for r in tables["stop_times"].collect()] == [("t1", "s1")]


def test_project_to_schema_absent_extra_and_strict_cast(spark):
    df = spark.createDataFrame([("1", "a", "x", "extra"), ("", "b", "2", "y")],
                               "id string, name string, n string, junk string")
    out = G.project_to_schema(df, [("id", "int"), ("name", "str"), ("n", "int"),
                                   ("missing", "float")], strict=False)
    assert out.columns == ["id", "name", "n", "missing"]
    assert [tuple(r) for r in out.collect()] == [(1, "a", None, None), (None, "b", 2, None)]
    with pytest.raises(Exception):
        G.project_to_schema(df, [("n", "int")], strict=True).collect()


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([("1", "", None, " "), ("2", None, None, "")],
                               "a string, b string, c string, d string")
    assert Q.drop_empty_columns(df).columns == ["a", "d"]
    empty = spark.createDataFrame([], "a string, b string")
    assert Q.drop_empty_columns(empty).columns == ["a", "b"]


def test_dimension_loaders(spark, feed):
    stops = D.dim_stations(G.read_feed_text(spark, feed, "stops"))
    s = {r.stop_id: r for r in stops.collect()}
    assert s["8892007"].stop_name == "Gent-Sint-Pieters"  # tab-padded name stripped
    assert s["8000001"].stop_name == "Unknown Station"
    assert s["8813003"].wheelchair_boarding == 1 and s["8892007"].wheelchair_boarding is None
    routes = D.dim_routes(G.read_feed_text(spark, feed, "routes"))
    assert {r.route_id: r.route_type for r in routes.collect()} == {"r1": 2, "r2": 2, "r3": 2}
    kept, rejected = D.dim_trips(G.read_feed_text(spark, feed, "trips"), routes)
    k = {r.trip_id: r for r in kept.collect()}
    assert set(k) == {"t1", "t2"} and k["t2"].service_id == "UNKNOWN"
    assert {r.trip_id for r in rejected.collect()} == {"t3", "t4"}  # unknown and NULL route
    c = D.dim_trips_counts(G.read_feed_text(spark, feed, "trips"), routes).first()
    assert (c.kept, c.rejected) == (2, 2)


def test_fk_and_pk_checks(spark, feed):
    t = G.read_feed(spark, feed, ["routes", "stops", "trips", "stop_times"])
    rep = Q.fk_report([
        ("trips", t["trips"], "route_id", "routes", t["routes"], "route_id"),
        ("stops", t["stops"], "parent_station", "stops", t["stops"], "stop_id"),
        ("stop_times", t["stop_times"], "trip_id", "trips", t["trips"], "trip_id"),
    ])
    got = {(r.child_table, r.child_column): r.violations for r in rep.collect()}
    # NULL route (t4) is allowed by a FK; rX is not; broken parent 9999999.
    assert got == {("trips", "route_id"): 1, ("stops", "parent_station"): 1,
                   ("stop_times", "trip_id"): 0}
    dup = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, s int")
    assert [tuple(r) for r in Q.pk_violations(dup, ["k", "s"]).collect()] == [("a", 1, 2)]
    nn = Q.not_null_violations(t["trips"], ["route_id", "service_id"])
    assert {r.column_name: r.null_count for r in nn.collect()} == {"route_id": 1,
                                                                   "service_id": 1}
    w = Q.width_violations(t["routes"], {"route_long_name": 10})
    assert w.first().violations == 1


def test_cascade_purge(spark):
    parents = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "pk int, ts int")
    children = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "pk int, v string")
    kp, kc, purged = Q.cascade_purge(parents, children, "pk", F.col("ts") < 15)
    assert sorted(r.pk for r in kp.collect()) == [2, 3]
    assert sorted(r.v for r in kc.collect()) == ["c", "d"]
    assert [r.pk for r in purged.collect()] == [1]
