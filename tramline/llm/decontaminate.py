"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items form one automaton: every path from
its root spells consecutive words of an item. Document words are streamed
through it, keeping the longest match that ends at each word; where the match
reaches the window length the window's words are hit. Only stretches of
words that some item uses, long enough for a window, enter the automaton.

Items are few and fixed in size next to the corpus. They reach the tasks in
chunks of at most ``MAX_CHUNK_WORDS`` words, one automaton each, so memory is
bounded however many items there are; each chunk is one more pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.llm.common import bounded_batches, stored, text_chunks

WINDOW = 13
MIN_PERCENT = 5          # a text is contaminated if this share of its words is hit
MAX_CHUNK_WORDS = 300_000  # about 150 MB of automaton in a task

# Word bytes after lower-casing A-Z are digits, a-z and all of UTF-8 above ASCII.
_TO_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORD).split()


class SuffixAutomaton:
    """Suffix automaton of several word sequences.

    ``found[state]`` maps a window that is the state's substring of that
    length to the items that contain it, for the window lengths asked for.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.found: dict[int, list[tuple[int, set[str]]]] = {}
        coded = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words])
                 for name, words in items if words]
        self.shortest = min((min(len(w), window) for _, w in coded), default=0)
        for _, word_ids in coded:
            last = 0
            for w in word_ids:
                last = self._extend(last, w)
        for name, word_ids in coded:
            self._mark(name, word_ids)
        self._inherit()

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:  # an earlier item already spells this
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = self._state(length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p < 0:
            link[cur] = 0
        else:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        c = self._state(self.length[p] + 1)
        self.next[c] = dict(self.next[q])
        self.link[c] = self.link[q]
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _mark(self, name: str, word_ids: list[int]) -> None:
        size = min(self.window, len(word_ids))
        state = 0
        for k, w in enumerate(word_ids):
            state = self.next[state][w]
            if k + 1 < size:
                continue
            at = state  # the state whose substrings include the one of this length
            while self.length[self.link[at]] >= size:
                at = self.link[at]
            own = self.found.setdefault(at, [])
            for n, names in own:
                if n == size:
                    names.add(name)
                    break
            else:
                own.append((size, {name}))

    def _inherit(self) -> None:
        """Each state also finds what the states on its suffix path find."""
        self.on_path: list[tuple[tuple[int, set[str]], ...]] = [()] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = self.on_path[self.link[s]]
            self.on_path[s] = (*above, *self.found[s]) if s in self.found else above

    def hits(self, word_ids: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """(first, end) of the windows found in words (-1: in no item), and their items."""
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        if not self.shortest or len(word_ids) < self.shortest:
            return spans, names
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word_ids >= 0, [False]]).astype(np.int8)))
        nxt, link, length, on_path = self.next, self.link, self.length, self.on_path
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a < self.shortest:
                continue
            state, matched = 0, 0
            for k, w in enumerate(word_ids[a:b].tolist(), a + 1):
                while state and w not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if w in nxt[state]:
                    state = nxt[state][w]
                    matched += 1
                if on_path[state]:
                    for n, items in on_path[state]:
                        if n <= matched:
                            spans.append((k - n, k))
                            names |= items
        return spans, names


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_chunks(benchmark: DataFrame) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items' words, at most ``MAX_CHUNK_WORDS`` at a time (an item alone may exceed it)."""
    chunk: list[tuple[str, list[bytes]]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("name"), "text").where("text is not null")
    for row in rows.toLocalIterator():
        words = words_of(row["text"].encode())
        if chunk and size + len(words) > MAX_CHUNK_WORDS:
            yield chunk
            chunk, size = [], 0
        if words:
            chunk.append((row["name"], words))
            size += len(words)
    yield chunk


def _scan(texts: list[bytes], automaton: SuffixAutomaton):
    """For each text: its number of words, merged hit spans, items."""
    get = automaton.ids.get
    for t in texts:
        words = words_of(t)
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        spans, names = automaton.hits(ids)
        yield len(words), _merged(spans), names - {None}


# Columns that ``mark`` adds.
WORDS, EDGES, ITEMS = "__hit_words", "__hit_edges", "__hit_items"


def _pass(docs: DataFrame, items: list[tuple[str, list[bytes]]], window: int) -> DataFrame:
    """Adds what one chunk of items hits to the columns WORDS, EDGES and ITEMS."""
    shared = docs.sparkSession.sparkContext.broadcast(items)  # at most MAX_CHUNK_WORDS words
    kept = [c for c in docs.columns if c not in (WORDS, EDGES, ITEMS)]
    again = EDGES in docs.columns

    def run(batches):
        automaton = SuffixAutomaton(shared.value, window)
        for batch in batches:
            for first, texts in text_chunks(batch):
                part = batch.slice(first, len(texts))
                counts, edges, names = [], [], []
                for n, spans, own in _scan(texts, automaton):
                    counts.append(n)
                    edges.append(spans)
                    names.append(own)
                if again:
                    for i, (e, x) in enumerate(zip(part.column(EDGES).to_pylist(),
                                                   part.column(ITEMS).to_pylist())):
                        edges[i] = _merged(edges[i] + list(zip(e[::2], e[1::2])))
                        names[i] |= set(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [
                        pa.array(counts, pa.int64()),
                        pa.array([[x for s in e for x in s] for e in edges], pa.list_(pa.int64())),
                        pa.array([sorted(x) for x in names], pa.list_(pa.string()))],
                    names=[*kept, WORDS, EDGES, ITEMS])
    schema = T.StructType([f for f in docs.schema.fields if f.name in kept]
                          + [T.StructField(WORDS, T.LongType()),
                             T.StructField(EDGES, T.ArrayType(T.LongType())),
                             T.StructField(ITEMS, T.ArrayType(T.StringType()))])
    return docs.mapInArrow(run, schema)


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the number of words, the hit word spans (first, end, first, end, ...)
    and the ids of the items whose windows occur."""
    bounded_batches(docs.sparkSession)
    for k, items in enumerate(item_chunks(benchmark)):
        docs = _pass(stored(docs, "hits") if k else docs, items, window)
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null or empty text has no words and is never contaminated. Items
    without words match nothing; an empty benchmark gives no hits. Repeated
    rows are judged one by one; repeated item ids count once. An item without an
    id hits like any other, but is neither counted nor named. Other columns
    are not read.
    """
    n_hit = _n_hit()
    return mark(docs.select("doc_id", "text"), benchmark, window).select(
        "doc_id", F.col(WORDS).alias("n_words"), n_hit.alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(ITEMS)), 256).alias("items_sha256"),
        _contaminated().alias("contaminated"))


def _n_hit():
    """Ends less firsts of the hit spans."""
    signed = F.transform(F.col(EDGES), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def _contaminated():
    return (_n_hit() > 0) & (_n_hit() * 100 >= F.col(WORDS) * MIN_PERCENT)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all their columns as they were.

    Null and empty texts stay; repeated rows stay or go each; a null doc_id
    plays no part. An empty table gives no rows.
    """
    return mark(docs, benchmark, window).where(~_contaminated()).select(*(F.col(f"`{c}`") for c in docs.columns))


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 min_words: int = WINDOW) -> DataFrame:
    """``docs`` whose texts have lost the hit spans of at least ``min_words`` words.

    The text from a span's first word up to the next kept word goes; texts
    without such a span, null texts among them, stay as they are. Repeated
    rows are cut alike; without documents or items nothing changes.
    """
    marked = mark(docs, benchmark, window)
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, e in enumerate(batch.column(EDGES).to_pylist()):
                spans = [s for s in zip(e[::2], e[1::2]) if s[1] - s[0] >= min_words]
                if spans:
                    texts[i] = _without(texts[i].encode(), spans).decode()
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names],
                names=names)
    return marked.mapInArrow(run, docs.schema)


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    starts = [m.start() for m in re.finditer(rb"[^ ]+", text.translate(_TO_WORD))] + [len(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:starts[a]])
        at = starts[b]
    return b"".join([*out, text[at:]])
