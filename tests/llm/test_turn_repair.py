"""Operator 11 against searches over all edits, in one chunk and in many."""

import hashlib
import random
import re
import zlib

import pytest

from tramline.llm import turn_repair as tr

GRAMMAR = re.compile("(s?(ua)+)?")


def _search(codes, longest_audit):
    """Least (cost, audit) by trying every sequence of edits, cheapest first."""
    import heapq
    heap = [(0, "", 0, "")]
    while heap:
        cost, audit, i, made = heapq.heappop(heap)
        if i == len(codes) and GRAMMAR.fullmatch(made):
            return cost, audit
        if len(audit) == longest_audit:
            continue
        if i < len(codes):
            code = codes[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, made))
            if code not in "bd":
                extra = 3 * code.isupper()
                heapq.heappush(heap, (cost + extra, audit + "K", i + 1, made + code.lower()))
                for role in "ua":
                    heapq.heappush(heap, (cost + extra + 3, audit + "R", i + 1, made + role))
        for role in "ua":
            heapq.heappush(heap, (cost + 3, audit + "I", i, made + role))


@pytest.mark.parametrize("seed", range(60))
def test_least_cost_and_audit(seed):
    rng = random.Random(seed)
    codes = "".join(rng.choice("ssuuuaaaxSUAXbd") for _ in range(rng.randrange(1, 5)))
    assert tr.repair_codes(codes)[:2] == _search(codes, 9)


def _forward(codes):
    """Least (cost, audit) by last letter, turn by turn."""
    never = (1 << 30, "")
    add = lambda x, cost, edit: (x[0] + cost, x[1] + edit)
    state = {"0": (0, ""), "s": never, "u": never, "a": never}

    def inserted(x):
        x = dict(x)
        x["u"] = min(x["u"], add(min(x["0"], x["s"], x["a"]), 3, "I"))
        x["a"] = min(x["a"], add(x["u"], 3, "I"))
        return x
    for code in codes:
        x = inserted(state)
        state = {k: add(v, 4, "D") for k, v in x.items()}
        if code not in "bd":
            extra, kind = 3 * code.isupper(), code.lower()
            if kind == "s":
                state["s"] = min(state["s"], add(x["0"], extra, "K"))
            for letter, source in (("u", min(x["0"], x["s"], x["a"])), ("a", x["u"])):
                edit = (extra, "K") if kind == letter else (3 + extra, "R")
                state[letter] = min(state[letter], add(source, *edit))
    x = inserted(state)
    return min(x["0"], x["a"])


@pytest.mark.parametrize("seed", range(150))
def test_longer_strings(seed):
    rng = random.Random(seed)
    codes = "".join(rng.choice(rng.choice(["ua", "suaxSUAXbd", "uuab"])) for _ in range(rng.randrange(1, tr.CHUNK + 1)))
    assert tr.repair_codes(codes)[:2] == _forward(codes)


def _brute(rows, damaged):
    """Expected rows, conversation by conversation."""
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(name.encode()) % 20 if damaged else 19
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        talks[conv] += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    out = []
    for conv, turns in talks.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, codes, n = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, role, text in turns:
            words = text.strip(" \t\n\x0b\x0c\r")
            kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
            fault = "b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            codes += fault if fault in ("b", "d") else kind.upper() if fault else kind
        cost, audit = _forward(codes) if turns else (0, "")
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        places = [t for t, _, _ in turns if t is not None]
        gaps = max(places) - min(places) + 1 - len({*places}) if places else 0
        made, rest, last = [], iter(turns), "0"
        for edit in audit:
            role = "assistant" if last == "u" else "user"
            if edit != "I":
                _, own, text = next(rest)
                if edit == "D":
                    continue
                role = own if edit == "K" else role
            made.append(f"{role}:{'' if edit == 'I' else text}")
            last = role[0]
        assert GRAMMAR.fullmatch("".join(x[0] for x in made))
        out.append((conv, gaps, n["b"], n["d"], n["t"], illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=str)


def _rows(seed, conversations=60, longest=12):
    rng = random.Random(seed)
    rows = []
    for c in [None, *range(conversations)]:
        for t in range(rng.randrange(1, longest)):
            rows.append((c, rng.choice([t, t, t, t, 3, None]),
                         rng.choice(["user", "assistant", "user", "assistant", "system", "", None, "x"]),
                         rng.choice(["Yes.", "Cut", "", None, " \n ", f"New {rng.random()}!", "Ok? \n"])))
    return rows + rng.sample(rows, 5)


SCHEMA = "conv_id bigint, turn bigint, role string, text string, seq int, chunk int, kind string, cid string, cost int, live int"


@pytest.mark.parametrize("seed,longest,chunk,damaged", [(1, 12, 32, True), (2, 12, 2, True), (3, 40, 3, False), (4, 90, 8, True)])
def test_rows_against_brute_force(spark, monkeypatch, seed, longest, chunk, damaged):
    monkeypatch.setattr(tr, "CHUNK", chunk)
    rows = _rows(seed, longest=longest)
    turns = spark.createDataFrame([(*r, *[None] * 6) for r in rows], SCHEMA).repartition(4)
    got = tr.repair(tr.damage(turns) if damaged else turns).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute(rows, damaged)


def test_one_hot_conversation(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant"]), rng.choice(["Same.", f"Turn {t}.", "cut", ""])) for t in range(3000)]
    rows += [(8, 0, "user", "Same."), (8, 0, "user", "Same.")] * 40
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = tr.repair(turns, with_text=True).collect()
    assert sorted((tuple(r)[:-1] for r in got), key=str) == _brute(rows, False)
    assert all(hashlib.sha256(r["repaired"].encode()).hexdigest() == r["repaired_sha256"] for r in got)


def test_lost_rows_and_empty_table(spark):
    rows = [(1, 0, "user", "Hi.", True), (2, 0, "user", "Hi.", True), (2, 1, "user", "Ok.", False)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, lost boolean")
    got = sorted(tuple(r) for r in tr.repair(turns).collect())
    nothing, made = hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"user:Ok.\nassistant:").hexdigest()
    assert got == [(1, 0, 0, 0, 0, 0, 0, "", nothing), (2, 0, 0, 0, 0, 0, 3, "KI", made)]
    assert tr.repair(turns.limit(0)).collect() == []


def test_long_text(spark):
    rows = [(1, 0, "user", "word " * 300_000 + "."), (1, 1, "assistant", ". " * 200_000), (1, 2, "user", " " * 500_000)]
    got = tr.repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert [tuple(r) for r in got] == _brute(rows, False)
