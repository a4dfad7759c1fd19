"""Operator 12 against the sentencepiece library: whole texts, random strings, awkward rows."""

import hashlib
import random

import numpy as np
import pytest
from public_tokenizers import path

from tramline.llm.sentencepieces import MARK, SHORT, Vocabulary, encode_texts

MODEL = path("piece_bpe_32k.model")
ALPHABET = f" {MARK}  \n\t\x00abcehrt<>0xAs/é日本\U0001d4b3\U0001f389　\xa0.,!ThTHE�́²».(\"'_[]…"


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(MODEL)


def _library(v, text):
    return np.array(v.library.encode(text, add_bos=True, add_eos=True), "<u4").tobytes()


def _digests(v, text):
    ids = _library(v, text or "")
    back = v.library.decode(np.frombuffer(ids, "<u4").tolist())
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


@pytest.mark.parametrize("seed", range(4))
def test_random_strings(vocabulary, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["".join(rng.choice("eth ") for _ in range(rng.randrange(200))) for _ in range(200)]
    for text, ids in zip(texts, vocabulary.encode(texts, checked="texts")):
        assert ids == _library(vocabulary, text)
        assert vocabulary.decode(ids).decode() == vocabulary.library.decode(np.frombuffer(ids, "<u4").tolist())


def test_any_ids_decode_as_the_library(vocabulary):
    rng = random.Random(5)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(270), rng.randrange(32000)]) for _ in range(rng.randrange(12))]
        assert vocabulary.decode(np.array(ids, "<u4").tobytes()).decode() == vocabulary.library.decode(ids)


def test_units_join_to_the_text(vocabulary):
    rng = random.Random(6)
    for _ in range(2000):
        text = MARK + "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))).replace(" ", MARK)
        assert "".join(vocabulary.units.findall(text)) == text


def test_list_and_heap_agendas_agree(vocabulary):
    rng = random.Random(7)
    for _ in range(3000):
        unit = "".join(rng.choice("etha▁nions") for _ in range(rng.randrange(1, SHORT)))
        assert vocabulary._short(unit) == vocabulary._long(unit)


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 100_000, "日" * 30_000, "ab\n" * 50_000, "the " * 700_000])
def test_long_texts(vocabulary, text):
    assert vocabulary.encode([text])[0] == _library(vocabulary, text)


def test_memory_of_units_is_bounded(vocabulary, monkeypatch):
    import tramline.llm.sentencepieces as m
    monkeypatch.setattr(m, "MAX_CACHED", 50)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(20)) for _ in range(40)]
    v = Vocabulary(MODEL)
    assert v.encode(texts) == [_library(v, t) for t in texts]
    assert len(v.known) <= 50


def test_a_wrong_merge_is_noticed():
    v = Vocabulary(MODEL)
    del v.order[f"{MARK}the"]
    with pytest.raises(AssertionError):
        v.encode(["the"])


def test_rows(spark):
    v = Vocabulary(MODEL)
    rows = [(1, "Hello  world"), (1, "Hello  world"), (None, "x"), (2, None), (3, ""), (4, " lead\n\n"), (5, "é" * 5000)]
    docs = spark.createDataFrame([(*r, "n", "i") for r in rows], "doc_id bigint, text string, n_tokens string, ids string")
    got = sorted(map(str, (tuple(r) for r in encode_texts(docs, MODEL).collect())))
    assert got == sorted(map(str, ((i, *_digests(v, t)) for i, t in rows)))
    full = encode_texts(docs, MODEL, checked="texts", with_ids=True, with_text=True).where("doc_id = 4").first()
    assert full["decoded"] == " lead\n\n" and full["ids"][0] == 1 and full["ids"][-1] == 2
    assert encode_texts(docs.limit(0), MODEL).collect() == []


def test_query_against_the_library(spark):
    import os

    from tramline.llm import catalog
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    v = Vocabulary(MODEL)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in catalog.queries()["op12_sentencepieces"](spark, sf).collect()}
    assert got == {i: _digests(v, t) for i, t in docs}
