"""Repair of conversations to the grammar "a system turn or none, then user and assistant by turns".

The turns of a conversation are aligned to the strings that the grammar
allows, one length after the other: Wagner and Fischer's table of costs, kept
to the diagonals that can cost no more than the best alignment so far
(Ukkonen's band), from the length of the conversation outwards until the
difference in length alone costs more. Alignments of equal cost are traced
back and the one with the least audit string stays.

A conversation of up to ``CHUNK`` turns is aligned as it is. A longer one is
cut into chunks of that size. The grammar remembers only its last letter, so
a chunk is a table of costs from letter to letter; these are filled apart,
folded from the end, and the chunks then aligned apart knowing what each last
letter costs from there on. So no task holds a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import stored

# Costs of the edits: Keep is free.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

CHUNK = 32
START = "0"             # the last letter, when there is none yet
STATES = (START, "s", "u", "a")
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 40


@lru_cache(maxsize=1 << 14)
def _turns(codes: str) -> list[tuple[str | None, int]]:
    """(initial, cost if it stays) of each turn; no initial where it must go."""
    return [(None, 0) if c in "bd" else (c.lower(), TRUNCATED * c.isupper()) for c in codes]


@lru_cache(maxsize=256)
def targets(last: str, n: int) -> list[str]:
    """What may follow the letter ``last`` in place of ``n`` turns, the nearest lengths first."""
    longest = n + most(n) // INSERT
    after = "au" if last == "u" else "ua"
    out = [(after * longest)[:m] for m in range(longest + 1)]
    if last == START:
        out += ["s" + ("ua" * longest)[:m] for m in range(longest)]
    return sorted(out, key=lambda t: (abs(len(t) - n), t))


def most(n: int) -> int:
    """No repair of ``n`` turns needs to cost more: two inserted turns reach any letter, then all turns go."""
    return DELETE * n + 2 * INSERT


def align(turns: list[tuple[str | None, int]], target: str, bound: int, trailing: bool) -> tuple[int, str] | None:
    """Least cost and least audit of turning ``turns`` into ``target`` for at most ``bound``, or nothing.

    ``trailing``: turns may be inserted after the last one.
    """
    n, m = len(turns), len(target)
    shift = m - n
    least = INSERT * shift if shift > 0 else -DELETE * shift
    if least > bound:
        return None
    wide = (bound - least) // (INSERT + DELETE)  # a diagonal further out costs one of both more
    low, high = min(0, shift) - wide, max(0, shift) + wide
    table = [[NEVER] * (m + 1) for _ in range(n + 1)]
    table[n][m] = 0
    for i in range(n, -1, -1):
        row, below = table[i], table[i + 1] if i < n else None
        kind, stays = turns[i] if i < n else (None, 0)
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = row[j]
            if below and below[j] + DELETE < best:
                best = below[j] + DELETE
            if j < m:
                letter = target[j]
                if letter != "s" and (below or trailing) and row[j + 1] + INSERT < best:
                    best = row[j + 1] + INSERT
                if kind:
                    cost = stays if kind == letter else stays + REROLE if letter != "s" else NEVER
                    if below[j + 1] + cost < best:
                        best = below[j + 1] + cost
            row[j] = best
    if table[0][0] > bound:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:  # the least letter that keeps the cost: D, I, K, R
        left = table[i][j]
        kind, stays = turns[i] if i < n else (None, 0)
        if i < n and table[i + 1][j] + DELETE == left:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and (i < n or trailing) and table[i][j + 1] + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if kind == target[j] and table[i + 1][j + 1] + stays == left else "R")
            i, j = i + 1, j + 1
    return table[0][0], "".join(audit)


@lru_cache(maxsize=1 << 16)
def repair_codes(codes: str, last: str = START, ends: tuple[int, ...] = (0, NEVER, NEVER, 0),
                 trailing: bool = True) -> tuple[int, str, str] | None:
    """(cost, audit, last letter) of the cheapest repair, ties by audit; the cost holds ``ends`` of its last letter.

    ``codes``: one letter a turn: its initial (x: another), in capitals if
    truncated, b or d if it must go.
    """
    turns = _turns(codes)
    best: tuple[int, str, str] | None = None
    for target in targets(last, len(turns)):
        letter = target[-1] if target else last
        end = ends[STATES.index(letter)]
        if end == NEVER:
            continue
        bound = min(most(len(turns)), best[0] - end) if best else most(len(turns))
        found = align(turns, target, bound, trailing)
        if found and (best is None or (found[0] + end, found[1]) < best[:2]):
            best = (found[0] + end, found[1], letter)
    return best


def damage(turns: DataFrame) -> DataFrame:
    """The rows damaged by crc32 of ``conv_id:turn`` modulo 20; nulls become one space. ``lost`` marks dropped rows.

    0 drops a row, 1 empties its text, 2 takes away its sentence ends,
    3 repeats it, 4 makes it a user's.
    """
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c)
                     for c in ("conv_id", ":", "turn")))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("__h"))
    h = F.col("__h")
    copies = F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.withColumn("__copy", F.explode(copies))
            .select("conv_id", "turn", F.when(h == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(h == 1, "").when(h == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    (h == 0).alias("lost")))


def _in_order(turns: DataFrame) -> DataFrame:
    """The rows in order: ``seq`` rises with conversation and turn, ``chunk`` is the first seq of up to CHUNK rows.

    Ranges are bounded by prefixes, so the driver sees no whole text.
    """
    space = r"\x20\x09-\x0D"
    fault = (F.when(~F.col("text").rlike(f"[^{space}]"), "b")
             .when(F.col("text").rlike(rf"[.!?][{space}]*\z"), ".").otherwise("t"))
    initial = F.substring("role", 1, 1)
    rows = turns.select(
        "conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("cid"), "turn",
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (~F.coalesce("lost", F.lit(False))).alias("live") if "lost" in turns.columns else F.lit(True).alias("live"))
    rows = rows.withColumns({"kind": F.when(initial.isin("s", "u", "a"), initial).otherwise("x"), "fault": fault,
                             "digest": F.unhex(F.sha2(F.concat_ws("\0", "role", "text"), 256))})
    sorted_rows = (rows.repartitionByRange("cid", "turn", F.substring("role", 1, 32), F.substring("text", 1, 64))
                   .sortWithinPartitions("cid", "turn", "role", "text"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        held, chunk, size = None, at, 0
        for batch in batches:
            seqs, chunks = [], []
            for cid, live in zip(batch.column("cid").to_pylist(), batch.column("live").to_pylist()):
                if cid != held or (live and size == CHUNK):
                    held, size = cid, 0
                if live:
                    if not size:
                        chunk = at
                    size += 1
                seqs.append(at)
                chunks.append(chunk if live else at)
                at += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seqs, pa.int64()), pa.array(chunks, pa.int64())],
                                             names=[*batch.schema.names, "seq", "chunk"])
    schema = ", ".join(f"{c} {t}" for c, t in sorted_rows.dtypes)
    return stored(sorted_rows.mapInArrow(number, f"{schema}, seq bigint, chunk bigint"), "turns")


def _codes(rows: DataFrame) -> DataFrame:
    """The codes of each chunk in order. A turn whose role and text came before in its conversation must go."""
    repeated = (rows.where("live AND fault <> 'b'").groupBy("cid", "digest")
                .agg(F.min("seq").alias("__first"), F.count("*").alias("__n")).where("__n > 1")
                .select("cid", "digest", "__first"))
    code = (F.when(F.col("fault") == "b", "b").when(F.col("seq") > F.col("__first"), "d")
            .when(F.col("fault") == "t", F.upper("kind")).otherwise(F.col("kind")))
    listed = F.array_sort(F.collect_list(F.struct("seq", "code")))  # CHUNK at most
    return (rows.where("live").select("cid", "digest", "seq", "chunk", "kind", "fault")
            .join(repeated, ["cid", "digest"], "left").withColumn("code", code)
            .groupBy("cid", "chunk").agg(F.array_join(F.transform(listed, lambda x: x["code"]), "").alias("codes")))


def _each(fn, schema: str):
    """A ``mapInArrow`` function that yields a row for each row: ``fn`` takes and returns tuples."""
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string())}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = fn()
        for batch in batches:
            got = [step(*x) for x in zip(*(c.to_pylist() for c in batch.columns))]
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), types)], names=names)
    return run


PLAN = "cid string, chunk bigint, codes string, last string, cost bigint, audit string"


def _whole():
    def one(cid, chunk, codes):
        cost, audit, _ = repair_codes(codes)
        return cid, chunk, codes, START, cost, audit
    return one


def _costs():
    """Each chunk's costs from letter to letter (16), and from each letter to the end of a conversation (4)."""
    def one(cid, chunk, codes):
        cost = lambda got: got[0] if got else NEVER
        only = [tuple(0 if x == y else NEVER for y in STATES) for x in STATES]
        return (cid, chunk, codes, [cost(repair_codes(codes, e, x, False)) for e in STATES for x in only],
                [cost(repair_codes(codes, e)) for e in STATES])
    return one


def _backward():
    """What each last letter of a chunk costs from there on; empty for the last chunk. Rows come last chunk first."""
    held, ahead = None, [0] * 4

    def one(cid, chunk, codes, inner, final):
        nonlocal held, ahead
        mine = ahead if cid == held else []
        ahead = [min(NEVER, *(inner[4 * e + x] + ahead[x] for x in range(4))) for e in range(4)] if mine else final
        held = cid
        return cid, chunk, codes, mine
    return one


def _options():
    """Each chunk's repair from every letter: cost of its own, audit, last letter."""
    def one(cid, chunk, codes, ends):
        costs, audits, lasts = [], [], []
        low = min(ends) if ends else 0  # equal chunks share their repairs
        key = tuple(x - low if x < NEVER else NEVER for x in ends)
        for e in STATES:
            got = repair_codes(codes, e, key, False) if ends else repair_codes(codes, e)
            costs.append(got[0] - (key[STATES.index(got[2])] if ends else 0) if got else NEVER)
            audits.append(got[1] if got else "")
            lasts.append(got[2] if got else START)
        return cid, chunk, codes, costs, audits, lasts
    return one


def _forward():
    held, last = None, START

    def one(cid, chunk, codes, costs, audits, lasts):
        nonlocal held, last
        if cid != held:
            held, last = cid, START
        k, before = STATES.index(last), last
        last = lasts[k]
        return cid, chunk, codes, before, costs[k], audits[k]
    return one


def _plan(chunks: DataFrame) -> DataFrame:
    """Each chunk's audit and the letter it starts after. Folds read a conversation's chunks in order, one at a time."""
    several = chunks.groupBy("cid").count().where("count > 1").select("cid")
    long = chunks.join(several, "cid", "left_semi")
    base = "cid string, chunk bigint, codes string"
    costs = long.mapInArrow(_each(_costs, s := f"{base}, inner array<bigint>, final array<bigint>"), s)
    ends = (costs.repartition("cid").sortWithinPartitions("cid", F.desc("chunk"))
            .mapInArrow(_each(_backward, s := f"{base}, ends array<bigint>"), s))
    options = ends.repartition("chunk").mapInArrow(
        _each(_options, s := f"{base}, costs array<bigint>, audits array<string>, lasts array<string>"), s)
    chosen = options.repartition("cid").sortWithinPartitions("cid", "chunk").mapInArrow(_each(_forward, PLAN), PLAN)
    return chunks.join(several, "cid", "left_anti").mapInArrow(_each(_whole, PLAN), PLAN).unionByName(chosen)


class _Conversation:
    """Counts and repaired text of one conversation, turn by turn."""

    def __init__(self, conv_id, keep_text: bool):
        self.conv_id, self.audit, self.cost = conv_id, [], 0
        self.faults = {"b": 0, "d": 0, "t": 0}
        self.illegal, self.initial = 0, None
        self.first = self.latest = None
        self.distinct = 0
        self.sha, self.lines = hashlib.sha256(), [] if keep_text else None
        self.empty, self.last, self.edits, self.codes = True, START, iter(""), iter("")

    def write(self, role: str, text: str) -> None:
        line = f"{role}:{text}"
        self.sha.update(b"" if self.empty else b"\n")
        self.sha.update(line.encode())
        self.empty = False
        if self.lines is not None:
            self.lines.append(line)

    def chunk(self, codes: str, last: str, cost: int, audit: str) -> None:
        self.finish()
        self.codes, self.last, self.edits = iter(codes), last, iter(audit)
        self.cost += cost
        self.audit.append(audit)

    def next_letter(self) -> str:
        return "a" if self.last == "u" else "u"

    def turn(self, turn, role: str, text: str) -> None:
        code = next(self.codes)
        fault = code if code in "bd" else "t" if code.isupper() else None
        if fault:
            self.faults[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.latest:
            self.first = turn if self.first is None else self.first
            self.latest, self.distinct = turn, self.distinct + 1
        for edit in self.edits:
            if edit == "D":
                return
            letter = role[0] if edit == "K" else self.next_letter()
            self.write(role if edit == "K" else ROLES[letter], "" if edit == "I" else text)
            self.last = letter
            if edit != "I":
                return

    def finish(self) -> None:
        for _ in self.edits:  # inserted after the last turn
            self.last = self.next_letter()
            self.write(ROLES[self.last], "")

    def row(self) -> tuple:
        self.finish()
        gaps = 0 if self.first is None else self.latest - self.first + 1 - self.distinct
        return (self.conv_id, gaps, self.faults["b"], self.faults["d"], self.faults["t"], self.illegal, self.cost,
                "".join(self.audit), self.sha.hexdigest(), *([] if self.lines is None else ["\n".join(self.lines)]))


def repair(turns: DataFrame, with_text: bool = False) -> DataFrame:
    """One row for each conversation of ``turns`` (conv_id, turn, role, text).

    Turns go by ``turn`` (nulls first), equal ones by role and text. A null
    role or text is one space; a null conv_id is a conversation of its own.
    A column ``lost``, if there, marks rows that only name their
    conversation; one without other rows has zeros, an empty audit and the
    digest of nothing. Repeated rows are turns like others, so duplicates. An
    empty table gives no rows; columns other than those named are not read.
    ``with_text`` adds the repaired turns as one text.

    The digest of a conversation needs its turns in order, so the last step
    streams a conversation through one task, a batch at a time.
    """
    rows = _in_order(turns)
    plan = stored(_plan(stored(_codes(rows), "codes")), "repairs")
    kind = dict(turns.dtypes)["conv_id"]
    one = rows.select("cid", "seq", F.lit(1).alias("__turn"), "conv_id", "turn", "role", "text", "live",
                      F.lit(None).cast("string").alias("codes"), F.lit(None).cast("string").alias("last"),
                      F.lit(None).cast("bigint").alias("cost"), F.lit(None).cast("string").alias("audit"))
    other = plan.select("cid", F.col("chunk").alias("seq"), F.lit(0).alias("__turn"), F.lit(None).cast(kind).alias("conv_id"),
                        F.lit(None).cast(dict(turns.dtypes)["turn"]).alias("turn"), F.lit(None).cast("string").alias("role"),
                        F.lit(None).cast("string").alias("text"), F.lit(None).cast("boolean").alias("live"),
                        "codes", "last", "cost", "audit")
    ordered = one.unionByName(other).repartition("cid").sortWithinPartitions("cid", "seq", "__turn")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    texts = ("audit", "repaired_sha256", *["repaired"] * with_text)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, plans, talk, done, kind = None, [], None, [], None
        pack = lambda: pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done), [kind, *[pa.int64()] * len(counts), *[pa.string()] * len(texts)])],
            names=["conv_id", *counts, *texts])
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for cid, _, is_turn, conv_id, turn, role, text, live, codes, last, cost, audit in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if cid != held:
                    if talk:
                        done.append(talk.row())
                    held, talk, plans = cid, None, []
                if not is_turn:
                    plans.append((codes, last, cost, audit))
                    continue
                talk = talk or _Conversation(conv_id, with_text)
                if live:
                    for p in plans:
                        talk.chunk(*p)
                    plans = []
                    talk.turn(turn, role, text)
            if done:
                yield pack()
                done = []
        if talk:
            done.append(talk.row())
            yield pack()
    return ordered.mapInArrow(fold, f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in counts) + ", "
                              + ", ".join(f"{c} string" for c in texts))
