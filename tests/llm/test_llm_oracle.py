"""Queries with SQL against DuckDB: on the smallest driver tables and on awkward rows."""

import os
import random

import duckdb
import pytest

import __spark_entry__ as E
from tramline.llm import catalog

SF = "/root/testdata/sf0.001"
KEYS = sorted(catalog.oracle_sql())
WORDS = [f"w{i}" for i in range(400)]
PASSAGE = " ".join(WORDS[100:190])

# doc_id is unique here; null ids and repeated rows are in test_llm_edges.
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One TWO"), (6, "x" * 49), (7, "y" * 50), (8, "y" * 50),
    (9, " ".join(WORDS[:100])), (10, " ".join(WORDS[:100]).upper()), (11, " ".join(WORDS[:95] + ["q"] * 5)),
    (12, PASSAGE + " tail one"), (13, "head two " + PASSAGE), (14, "é" * 60), (15, "é" * 60 + "z"),
    (16, "same line here now\n" * 40), (17, "a b c " * 200), (18, "ab" * 3000), (19, "\x00" * 55 + "\x00\x01"),
    (20, "foo\nLicensed under the Apache License, Version 2.0.\nbar All rights reserved."),
    (21, 'The software is provided "as is", without warranty of any kind. Released under the MIT license.'),
    (22, "Redistributions of source code must retain\nthe above copyright notice."),
    (23, " ".join(WORDS * 250)), (24, "# $ % & | < > *" * 30), (25, "\n\n\n"), (26, "w1 W2 w3 w4 w5 w6"),
    (27, "w1 w2 w3 w4 w5 w6 w7"), (28, "x y z. " + " ".join(WORDS[200:213]) + ", end"), (29, "short item"),
]
ITEMS = [(1, " ".join(WORDS[200:220])), (2, "Short ITEM"), (3, None), (4, "..."), (5, " ".join(WORDS[198:215])),
         (6, "short item"), (None, "one two")]


def _turns():
    """Conversations of 1 to 300 turns with nulls, odd roles, gaps, equal turns and repeated rows."""
    rng = random.Random(11)
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"])
    text = lambda: rng.choice(["Fine. ", "Why?", "Cut off", "", None, " \n", "é!\n", f"Number {rng.random()}.", "No. 5 "])
    rows = []
    for c in [None, *range(160), 900, 901]:
        n = 300 if c in (900, None) else 70 if c == 901 else rng.randrange(1, 12)
        wild = rng.random() < 0.6
        for t in range(n):
            rows.append((c, rng.choice([t, t, t, 5, None]) if wild else t,
                         role() if wild else ["user", "assistant"][t % 2], text() if wild else f"Turn {t}."))
        rows += rng.sample(rows[-n:], n // 4)
    return rows


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


def _compare(spark, key, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet/*.parquet')"
                    if os.path.isdir(f"{sf_dir}/{t}.parquet") else
                    f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = E.queries()[key](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert _canon(df.columns, got) == _canon(names, cur.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("key", KEYS)
def test_driver_tables(spark, key):
    _compare(spark, key, SF)


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("awkward"))
    spark.createDataFrame([(i, t, None, "s", 0) for i, t in ROWS],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint"
                          ).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").coalesce(1).write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(9, 1, 0), (17, 0, 0)], "doc_id bigint, quality int, toxic int").coalesce(1).write.parquet(
        f"{d}/labels.parquet")
    spark.createDataFrame(_turns(), "conv_id bigint, turn bigint, role string, text string").repartition(3).write.parquet(
        f"{d}/conversations.parquet")
    return d


@pytest.mark.parametrize("key", KEYS)
def test_awkward_rows(spark, awkward, key):
    _compare(spark, key, awkward)


def test_every_operator_is_registered_once():
    numbers = sorted(int(k[2:].split("_")[0]) for k in catalog.queries())
    assert numbers == list(range(1, 14))
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()
