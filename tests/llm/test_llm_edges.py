"""Null ids, repeated rows, clashing columns and empty tables for every operator and stage."""

import pytest

import corpus_pipeline
from tramline.llm import decontaminate, importance, licenses, lm_ppm, minhash, packing, pii, quality_rules
from tramline.llm import sharding, suffix_dedup

LONG = " ".join(f"word{i}" for i in range(60))
CLASH = ("shard int, slot bigint, kept boolean, count bigint, node bigint, row bigint, key string, id bigint, th bigint, "
         "part bigint, block bigint, text_crc32 bigint, spans string, base string, n bigint, rank bigint, n_chars bigint")
ROWS = [(None, LONG), (None, None), (1, LONG), (1, LONG), (2, LONG + " extra"), (3, "mail a.b@c.org now"), (3, ""),
        (4, None), (5, LONG + " " + LONG), (6, "tiny")]


def _path():
    from public_tokenizers import path
    return path("word_bpe_49k.json")


def _docs(spark, rows):
    width = len(CLASH.split(","))
    return spark.createDataFrame([(*r, *[None] * width) for r in rows], "doc_id bigint, text string, " + CLASH)


def _labels(spark, rows=((1, 1, 0), (2, 0, 0), (None, 1, 1), (3, None, None))):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def _items(spark):
    return spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(30))), (None, None)],
                                 "item_id bigint, text string")


OPERATORS = {
    "quality_rules": lambda s, d: quality_rules.quality_rules(d),
    "importance": lambda s, d: importance.importance_resample(d, _labels(s)),
    "licenses": lambda s, d: licenses.scan_licenses(d),
    "minhash": lambda s, d: minhash.near_duplicates(d),
    "ppm": lambda s, d: lm_ppm.score_texts(d),
    "pii": lambda s, d: pii.find_personal_data(d),
    "sharding": lambda s, d: sharding.shard_table(d),
    "packing": lambda s, d: packing.pack(d, _path()),
    "suffix": lambda s, d: suffix_dedup.remove_repeats(d),
    "decontaminate": lambda s, d: decontaminate.contamination(d, _items(s)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_each_and_empty_table(spark, name):
    got = OPERATORS[name](spark, _docs(spark, ROWS)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)
    assert OPERATORS[name](spark, _docs(spark, [])).collect() == []


def test_quality_rules_values(spark):
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(_docs(spark, ROWS)).collect() if r["doc_id"]}
    assert (got[1]["n_words"], got[1]["base_failed"], got[1]["kept"]) == (60, False, True)
    assert got[5]["n_repeat_words"] == 120 and got[5]["base_failed"]
    assert got[4]["n_words"] == 0 and got[4]["base_failed"]


def test_near_duplicates_values(spark):
    got = minhash.near_duplicates(_docs(spark, ROWS)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got if r["n_shingles"]} == {
        (None, 1), (1, 1), (2, 1), (3, 3), (5, 1), (6, 6)}
    stay = minhash.drop_near_duplicates(_docs(spark, ROWS))
    assert stay.columns == _docs(spark, []).columns
    assert sorted(str(r["doc_id"]) for r in stay.collect()) == ["1", "3", "4", "6", "None", "None"]


def test_suffix_values(spark):
    got = {(r["doc_id"], r["n_bytes"]): r for r in suffix_dedup.remove_repeats(_docs(spark, ROWS)).collect()}
    n = len(LONG)
    assert got[1, n]["n_removed"] == 0            # rows of one id do not remove each other's bytes
    assert got[None, n]["n_removed"] == n         # a null id is the last
    assert got[2, n + 6]["n_removed"] == n
    assert (got[5, 2 * n + 1]["n_removed"], got[5, 2 * n + 1]["n_spans"]) == (2 * n + 1, 1)  # doc 2 has the space too


def test_ppm_without_training_rows(spark):
    held = next(i for i in range(100) if __import__("zlib").crc32(str(i).encode()) % 7 == 2)
    r = lm_ppm.score_texts(spark.createDataFrame([(held, "ab")], "doc_id bigint, text string")).first()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (True, 2, 0, 0, 0.0)
    assert r["score"] == pytest.approx(3 * -__import__("math").log10(257))


def test_importance_without_labels_keeps_all(spark):
    got = importance.importance_resample(_docs(spark, ROWS), _labels(spark, [])).collect()
    assert all(r["kept"] for r in got) and {r["log_weight"] for r in got} == {0.0}


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    _items(spark).write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns(spark, sf_dir, name, stage):
    docs = _docs(spark, ROWS)
    got = stage(spark, docs, sf_dir)
    assert got.columns == docs.columns and got.schema == docs.schema
    assert got.count() <= len(ROWS)
    assert stage(spark, _docs(spark, []), sf_dir).count() == 0


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é x@y.org, +1 (234) 555-6789!", 9), (2, "none", 7), (3, None, None)],
                                 "doc_id bigint, text string, n_chars bigint")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.redact(docs).collect()}
    assert got == {1: ("é <EMAIL>, <PHONE>!", 19), 2: ("none", 7), 3: (None, None)}


def test_span_removal(spark):
    docs = _docs(spark, [(1, "Before. " + LONG + " After it."), (2, "clean"), (3, None)])
    got = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, _items(spark)).collect()}
    assert got[2] == "clean" and got[3] is None
    assert got[1].startswith("Before. word30") and got[1].endswith("After it.")
