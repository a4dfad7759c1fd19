"""SC-14: spellings of one station, and the components they come from."""

import random

import pytest

from tramline.operators import aliases as A


def _union_find(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {x: root(x) for x in up}


@pytest.mark.parametrize("seed,n,m", [(1, 30, 20), (2, 200, 180), (3, 12, 40)])
def test_components(spark, seed, n, m):
    rng = random.Random(seed)
    edges = [(f"n{rng.randrange(n):04}", f"n{rng.randrange(n):04}") for _ in range(m)]
    got = A.components(spark.createDataFrame(edges + [(None, "n0000"), ("n0001", None)], "u string, v string"))
    assert {r.node: r.component for r in got.collect()} == _union_find(edges)


def test_a_long_chain_takes_few_rounds(spark):
    edges = [(f"n{k:04}", f"n{k + 1:04}") for k in range(300)]
    got = A.components(spark.createDataFrame(edges, "u string, v string"))
    assert {r.component for r in got.collect()} == {"n0000"} and got.count() == 301


TRANSLATIONS = "table_name string, field_name string, field_value string, language string, translation string"


def test_two_spellings_without_a_parent_are_one_station(spark):
    stations = spark.createDataFrame([
        ("8", "Bruxelles-Midi"), ("3", "Brussel-Zuid"), ("5", "Brussels-South"), ("1", "Gent / Gand"), ("2", "gand "),
        ("4", "Luik"), ("6", "Liège"), ("7", "Aalst"), ("9", None), (None, "Aalst"), ("A", "")], "stop_id string, stop_name string")
    tr = spark.createDataFrame([
        ("stops", "stop_name", "Bruxelles-Midi", "nl", "Brussel-Zuid"), ("stops", "stop_name", "Brussel-Zuid", "en", "Brussels-South"),
        ("stops", "stop_name", "Luik / Liège", "de", "Lüttich"), ("routes", "route_name", "Luik", "fr", "Aalst"),
        ("stops", "stop_name", "Aalst", "fr", None)], TRANSLATIONS)
    got = {r.stop_id: r.canonical_id for r in A.station_aliases(stations, tr).collect()}
    assert got == {"8": "3", "3": "3", "5": "3", "1": "1", "2": "1", "4": "4", "6": "4", "7": "7", "9": "9", None: None, "A": "A"}
    assert A.station_aliases(stations.limit(0), tr.limit(0)).collect() == []
