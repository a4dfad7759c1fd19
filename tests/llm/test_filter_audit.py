"""Operator 13 against brute force: merges of lists, all orders, awkward rows."""

import random
from itertools import permutations

import pytest

from tramline.llm import filter_audit as fa

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.mark.parametrize("seed", range(200))
def test_merges(seed):
    rng = random.Random(seed)
    most = rng.choice([5, 40, 1000])
    lists = [sorted(rng.sample(range(most), rng.randrange(most))) for _ in range(rng.randrange(1, 6))]
    assert fa.union(lists) == sorted(set().union(*lists))
    assert fa.difference(lists[0], lists[-1]) == sorted({*lists[0]} - {*lists[-1]})
    at, key = rng.randrange(len(lists[0]) + 1), rng.randrange(most)
    want = next((i for i in range(at, len(lists[0])) if lists[0][i] >= key), len(lists[0]))
    assert fa.gallop(lists[0], key, at) == max(want, at)


def _fails(doc, docs):
    i, text, _ = doc
    text = text or ""
    words = text.encode().split()
    older = [j for j, t, _ in docs if (t or "") == text and j is not None and (i is None or j < i)]
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": bool(older)}


def brute_force(docs, labels):
    out = {}
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails = [_fails(d, docs) for d in docs]
    for part in {d[2] or "" for d in docs}:
        mine = [(d[0], f) for d, f in zip(docs, fails) if (d[2] or "") == part]
        sums = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, k in enumerate(order, 1):
                gone, stay = [x for x in left if x[1][k]], [x for x in left if not x[1][k]]
                failing = sum(x[1][k] for x in mine)
                out[part, "".join(order), step] = [
                    len(stay), len(gone), failing - len(gone), sum(x[1][k] and sum(x[1].values()) == 1 for x in mine),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
                sums[k] += len(gone)
                left = stay
        for (p, order, step), row in out.items():
            if p == part:
                row.append(sums[order[step - 1]])
    return out


def _documents(seed, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "B", "cd", "é", "x$", "Zz", "p" * 9, "q|"])
    docs = []
    for i in range(n):
        k = rng.randrange(8)
        text = (None if k == 0 else "" if k == 1 else " \n\t" if k == 2 else docs[rng.randrange(i)][1] if k == 3 and i
                else " ".join(f"{word()}{j % rng.choice([3, 500])}" for j in range(rng.choice([5, 199, 200, 260]))))
        docs.append((rng.choice([i, i, i, None, 7]), text, rng.choice(["en", "fr", "", None])))
    return docs


@pytest.mark.parametrize("seed,size", [(1, 3), (2, 1 << 15)])
def test_against_brute_force(spark, monkeypatch, seed, size):
    monkeypatch.setattr(fa, "RANGE", size)
    docs = _documents(seed)
    labels = [(i, random.Random(i).choice([0, 1, None]), random.Random(-i).choice([0, 1])) for i in range(80)] + [
        (None, 1, 1), (3, 1, 1), (3, 0, 0)]
    clash = "part string, fails int, n int, bits int, good int, toxic int, digest string, u int, k int, f0 int"
    d = spark.createDataFrame([(*x, *[None] * 10) for x in docs], "doc_id bigint, text string, lang string, " + clash)
    l = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")  # noqa: E741
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS]
           for r in fa.audit_filters(d.repartition(5), l).collect()}
    assert got == brute_force(docs, labels)
    assert fa.audit_filters(d.limit(0), l).collect() == []


def test_one_long_text_and_no_labels(spark):
    docs = [(1, "Word " * 400_000, "en"), (2, "Word " * 400_000, "en")]
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in fa.audit_filters(
        spark.createDataFrame(docs, "doc_id bigint, text string, lang string"),
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect()}
    assert got == brute_force(docs, [])
