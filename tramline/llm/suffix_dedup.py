"""Removal of repeated byte strings with suffix arrays.

A string of ``WIDTH`` bytes that occurs in two texts has the same minimizer
(the 24 bytes with the smallest hash in it) in both. So the minimizers that
two different texts share mark all places that can repeat; the rest of the
corpus is not looked at again. Round each shared minimizer lies a segment:
the bytes of all strings whose minimizer it is. Segments are dealt into
shards by minimizer, so equal strings meet in one shard. A shard merges equal
segments; where a minimizer has several, it sorts their suffixes by Larsson-Sadakane refinement in numpy,
takes common prefixes as Kasai does (all segments in step), and gives every
string of a group with WIDTH common bytes the group's smallest doc_id.

A minimizer of very many texts is split: its equal segments are first merged
by an aggregate, and what is left is sorted in several sub-shards whose
sorted strings are merged with each other by binary search.

Equal texts are one text throughout: all but the smallest doc_id's copy goes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import bounded_batches, n_buckets, stored, text_chunks

WIDTH = 50
GRAM = 24                     # shorter ones are shared by chance: their segments would be sorted for nothing
SPAN = WIDTH - GRAM + 1       # 24-byte strings in one of WIDTH bytes
RUN = 4096                    # strings of one segment at most
HOT = 4096                    # a minimizer of more texts is split
SHARD_SEGMENTS = 10_000       # under 1 MB of segments: random access stays in cache
RANGE_ANCHORS = 1_000_000     # minimizers that a task compares
SLICE = 2 << 20               # positions fit in 24 bits of a sort key
LAST = 2**63 - 1              # stands for a null doc_id: never the smaller one

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _grams(data: bytes) -> np.ndarray:
    """A 64-bit hash of the 24 bytes from each position."""
    n = len(data) - GRAM + 1
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = eight[:n] * _A
    for at in range(8, GRAM, 8):
        h ^= h >> np.uint64(29)
        h += eight[at:at + n] * _B
        h ^= h >> np.uint64(32)
        h *= _A
    return h ^ (h >> np.uint64(31))


def minimizers(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, hash, first string, end of strings) of the runs of strings with one minimizer.

    Strings first to end - 1 of that text, by their place, have it, at most
    RUN of them.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    held: list[tuple[int, int, bytes]] = []

    def take() -> None:
        if not held:
            return
        data = b"".join(x for _, _, x in held)
        sizes = np.array([len(x) for _, _, x in held])
        starts = np.cumsum(sizes) - sizes
        grams = _grams(data)
        key = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
        for step in (1, 2, 4, 8, SPAN - 16):
            key = np.minimum(key[:-step], key[step:])
        own = np.concatenate([np.arange(a, a + n - WIDTH + 1) for a, n in zip(starts, sizes)])
        at = (key[own] & np.uint64(0xFFFFFF)).astype(np.int64)
        which = np.repeat(np.arange(len(held)), sizes - WIDTH + 1)
        h = grams[at]  # a run with one hash is one segment, wherever its strings have it
        heads = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (which[1:] != which[:-1])]))
        inside = np.arange(len(at)) - np.repeat(heads, np.diff(np.concatenate([heads, [len(at)]])))
        new = np.flatnonzero(inside % RUN == 0)
        end = np.concatenate([new[1:], [len(at)]])
        w = which[new]
        shift = np.array([s for _, s, _ in held])[w] - starts[w]
        parts.append((np.array([t for t, _, _ in held])[w], h[new],
                      own[new] + shift, own[end - 1] + 1 + shift))
        held.clear()

    size = 0
    for t, text in enumerate(texts):
        for a in range(0, max(len(text) - WIDTH + 1, 0), SLICE):
            piece = text[a:a + SLICE + WIDTH - 1]
            if size + len(piece) > SLICE:
                take()
                size = 0
            held.append((t, a, piece))
            size += len(piece)
    take()
    if not parts:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts))


def suffix_ranks(symbols: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``symbols`` and the place of each suffix in it.

    ``left`` is how many symbols are left of the segment; a suffix ends with
    it, and equal suffixes go by place. Larsson-Sadakane: suffixes start
    sorted by 7 symbols; each round doubles the length by the ranks found so
    far, and sorts only the groups that are still tied.
    """
    n = len(symbols)
    eight = np.ndarray((n,), ">u8", symbols.tobytes() + bytes(8), strides=(1,)).astype(np.uint64)
    within = np.minimum(left, 7).astype(np.uint64)  # symbols of the first 7 that are in the segment
    blank = np.array([~np.uint64(0) << np.uint64(64 - 8 * k) if k else 0 for k in range(8)], np.uint64)
    key = (eight & blank[within]) | within          # an ended suffix before one that goes on with zeros
    order = np.argsort(key).astype(np.int32)  # a shard has far fewer than 2**31 symbols
    ordered = key[order]
    first = np.ones(n, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    del eight, within, key, ordered
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n, dtype=np.int32), np.int32(0)))
    done, longest = 7, int(left.max(initial=0))
    while True:
        tied = ~first
        tied[:-1] |= ~first[1:]
        places = np.flatnonzero(tied).astype(np.int32)  # places in the order that belong to tied groups
        if not len(places):
            break
        suffix = order[places]
        if done >= longest:  # what is tied now is equal up to its end
            order[places] = suffix[np.lexsort([suffix, rank[suffix]])]
            break
        after = np.where(left[suffix] > done, rank[np.minimum(suffix + done, n - 1)] + 1, 0)
        group = rank[suffix]
        combined = group.astype(np.int64) * (n + 1) + after
        by = np.argsort(combined)
        suffix, combined = suffix[by], combined[by]
        order[places] = suffix
        new = np.concatenate([[True], combined[1:] != combined[:-1]])
        first[places] = new
        rank[suffix] = places[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        done *= 2
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    return order, place


def common_prefixes(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, order: np.ndarray,
                    place: np.ndarray, left: np.ndarray, cap: int = WIDTH) -> np.ndarray:
    """Kasai: common prefix (up to ``cap``) of each suffix with the one before it in ``order``.

    From one place to the next in a segment the prefix loses one symbol at
    most, so it is only carried on; all segments take a step at a time.
    Suffixes shorter than ``cap`` are left out (0).
    """
    lcp = np.zeros(len(symbols), np.int16)
    carried = np.zeros(len(starts), np.int64)
    for step in range(int(sizes.max(initial=0)) - cap + 1):
        lanes = np.flatnonzero(sizes >= step + cap)
        here = starts[lanes] + step
        at = place[here]
        before = order[np.maximum(at - 1, 0)]
        length = np.maximum(carried[lanes] - 1, 0)
        limit = np.minimum(np.minimum(left[here], left[before]), cap)
        limit[at == 0] = 0
        length = np.minimum(length, limit)
        go = np.flatnonzero(length < limit)
        while len(go):
            same = symbols[here[go] + length[go]] == symbols[before[go] + length[go]]
            go = go[same]
            length[go] += 1
            go = go[length[go] < limit[go]]
        lcp[at] = length
        carried[lanes] = length
    return lcp


def string_groups(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct strings of WIDTH bytes of the segments.

    Returns all symbols, where among them the distinct strings begin (in the
    strings' order), for each string of each segment (segment after segment)
    its number among them, and where each segment's numbers begin.
    """
    sizes = np.array([len(s) for s in segments], np.int64)
    starts = np.cumsum(sizes) - sizes
    symbols = np.frombuffer(b"".join(segments), np.uint8)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(symbols))
    order, place = suffix_ranks(symbols, left)
    lcp = common_prefixes(symbols, starts, sizes, order, place, left)
    del place
    whole = left[order] >= WIDTH  # the other suffixes are shorter than a string
    order, lcp = order[whole], lcp[whole]
    new = lcp < WIDTH
    new[:1] = True
    group = np.empty(len(symbols), np.int64)
    group[order] = np.cumsum(new) - 1
    strings = sizes - WIDTH + 1
    return symbols, order[new], group[left >= WIDTH], np.cumsum(strings) - strings


def _strings_at(symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(symbols[places[:, None] + np.arange(WIDTH)]).view(f"S{WIDTH}").ravel()


def smallest_ids(segments: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each string of each segment the smallest id of a segment with it; where each begins."""
    _, strings, group, begins = string_groups(segments)
    least = np.full(len(strings), LAST)
    np.minimum.at(least, group, np.repeat(ids, [len(s) - WIDTH + 1 for s in segments]))
    return least[group], begins


def _spans(bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], bad.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _shard_spans(table: pa.Table) -> pa.Table:
    """Byte spans to remove, from the segments of one shard."""
    segments = table.column("segment").to_pylist()
    ids = table.column("id").to_numpy()
    seen: dict[bytes, int] = {}
    code = np.fromiter((seen.setdefault(s, len(seen)) for s in segments), np.int64, len(segments))
    least = np.full(len(seen), LAST)
    np.minimum.at(least, code, ids)
    lengths = np.fromiter(map(len, seen), np.int64, len(seen)) - WIDTH + 1
    # a string's segments share its minimizer: the strings of a minimizer's only segment are nowhere else
    group = np.zeros(len(seen), np.int64)
    group[code] = table.column("g").to_numpy()
    several = np.bincount(group)[group] > 1
    kinds = list(seen)
    own_least, begins = least.copy(), np.zeros(len(seen), np.int64)
    found = np.zeros(0, np.int64)
    if several.any():
        some = np.flatnonzero(several)
        found, begins[some] = smallest_ids([kinds[k] for k in some.tolist()], least[some])
        own_least[some] = np.minimum.reduceat(found, begins[some])
    rows, a, b = [], [], []
    first = table.column("first").to_numpy()
    # only segments whose string has a smaller id than the row's have spans
    for r in np.flatnonzero(own_least[code] < ids).tolist():
        k = code[r]
        x, y = _spans(found[begins[k]:begins[k] + lengths[k]] < ids[r]) if several[k] else (np.zeros(1, np.int64), lengths[k:k + 1])
        rows.append(np.full(len(x), r))
        a.append(x + first[r])
        b.append(y - 1 + first[r] + WIDTH)
    rows = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    return pa.table({"id": table.column("id").take(pa.array(rows)), "th": table.column("th").take(pa.array(rows)),
                     "a": pa.array(np.concatenate([*a, np.zeros(0)]).astype(np.int64)),
                     "b": pa.array(np.concatenate([*b, np.zeros(0)]).astype(np.int64))})


def _repeats(x: np.ndarray) -> np.ndarray:
    """Which elements occur twice or more."""
    ordered = np.sort(x)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(x), bool)
    return twice[np.minimum(np.searchsorted(twice, x), len(twice) - 1)] == x


def _shared_minimizers(texts: DataFrame, ranges: int, hot_from: int) -> DataFrame:
    """th, keys, hot, any_hot: for each text its minimizers that another text has too, as
    numbers (range and 32 bits of the hash) and whether so many texts have them."""
    def emit(batches):
        for batch in batches:
            ths = batch.column("th").to_numpy()
            for first, data in text_chunks(batch):
                text, h, _, _ = minimizers(data)
                part = ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                low = (h & np.uint64(0xFFFFFFFF)).astype("<u4")
                by = np.lexsort([text, low, part])
                part, low, text = part[by], low[by], text[by]
                edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else [0]
                own = ths[first:first + len(data)]
                small = "<u2" if len(data) <= 1 << 16 else "<u4"
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([int(part[a]) for a in edge[:-1]], pa.int64()),
                    "hashes": pa.array([low[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
                    "texts": pa.array([text[a:b].astype(small).tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
                    "ths": pa.array([own.tobytes()] * (len(edge) - 1), pa.binary())})

    def shared(table: pa.Table) -> pa.Table:
        low, owner = [], []
        for h, t, own in zip(*(table.column(c).to_pylist() for c in ("hashes", "texts", "ths"))):
            low.append(np.frombuffer(h, "<u4"))
            owner.append(np.frombuffer(own, "<i8")[np.frombuffer(t, f"<u{4 * len(t) // len(h)}")])
        low, owner = np.concatenate(low), np.concatenate(owner)
        some = np.flatnonzero(_repeats(low))  # most hashes occur once
        low, owner = low[some], owner[some]
        by = np.lexsort([owner, low])
        low, owner = low[by], owner[by]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
        low, owner = low[new], owner[new]  # equal texts count once
        heads = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]])) if len(low) else np.zeros(0, np.int64)
        times = np.diff(np.concatenate([heads, [len(low)]]))
        times = np.repeat(times, times)
        some = times > 1
        low, owner, hot = low[some], owner[some], (times[some] > hot_from).astype(np.uint8)
        part = table.column("part")[0].as_py()
        bucket = owner % ranges  # rows of one bucket of texts go on together
        by = np.lexsort([owner, bucket])
        low, owner, hot, bucket = low[by], owner[by], hot[by], bucket[by]
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(low) else [0]
        return pa.table({
            "bucket": pa.array([int(bucket[a]) for a in edge[:-1]], pa.int64()),
            "part": pa.array([part] * (len(edge) - 1), pa.int64()),
            "ths": pa.array([_runs(owner[a:b])[0].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
            "sizes": pa.array([_runs(owner[a:b])[1].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
            "hashes": pa.array([low[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
            "hot": pa.array([hot[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())})

    def gather(table: pa.Table) -> pa.Table:
        owner, key, hot = [], [], []
        for part, ths, sizes, low, h in zip(*(table.column(c).to_pylist() for c in (
                "part", "ths", "sizes", "hashes", "hot"))):
            owner.append(np.repeat(np.frombuffer(ths, "<i8"), np.frombuffer(sizes, "<u4")))
            key.append(np.frombuffer(low, "<u4") | (np.uint64(part) << np.uint64(32)))
            hot.append(np.frombuffer(h, np.uint8))
        owner, key, hot = np.concatenate(owner), np.concatenate(key), np.concatenate(hot)
        by = np.lexsort([key, owner])
        owner, key, hot = owner[by], key[by], hot[by]
        own, sizes = _runs(owner)
        edge = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        return pa.table({
            "th": pa.array(own, pa.int64()),
            "keys": pa.array([key[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
            "hot": pa.array([hot[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
            "any_hot": pa.array([bool(hot[a:b].any()) for a, b in zip(edge[:-1], edge[1:])])})

    blobs = texts.select("th", "text").mapInArrow(emit, "part bigint, hashes binary, texts binary, ths binary")
    found = blobs.groupBy("part").applyInArrow(
        shared, "bucket bigint, part bigint, ths binary, sizes binary, hashes binary, hot binary")
    return found.groupBy("bucket").applyInArrow(gather, "th bigint, keys binary, hot binary, any_hot boolean")


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values and how often each comes."""
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    return ordered[heads], np.diff(np.concatenate([heads, [len(ordered)]])).astype("<u4")


def _segments(found: DataFrame, ranges: int) -> DataFrame:
    """h, hot, id, th, first, segment of every shared minimizer of the texts in ``found``."""
    def run(batches):
        for batch in batches:
            ids, ths = batch.column("id").to_numpy(), batch.column("th").to_numpy()
            keys, hot = batch.column("keys").to_pylist(), batch.column("hot").to_pylist()
            for start, data in text_chunks(batch):
                text, h, first, end = minimizers(data)
                part = (((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)) << np.uint64(32)
                key = part | (h & np.uint64(0xFFFFFFFF))
                edge = np.searchsorted(text, np.arange(len(data) + 1))
                keep, hots = np.zeros(len(h), bool), np.zeros(len(h), bool)
                for t in range(len(data)):
                    a, b = edge[t], edge[t + 1]
                    known = np.frombuffer(keys[start + t], "<u8")  # sorted
                    place = np.minimum(np.searchsorted(known, key[a:b]), len(known) - 1)
                    keep[a:b] = known[place] == key[a:b]
                    hots[a:b] = keep[a:b] & (np.frombuffer(hot[start + t], np.uint8)[place] > 0)
                at = np.flatnonzero(keep)
                yield pa.RecordBatch.from_pydict({
                    "h": pa.array(h[at].view(np.int64)), "hot": pa.array(hots[at]),
                    "id": pa.array(ids[start + text[at]]), "th": pa.array(ths[start + text[at]]),
                    "first": pa.array(first[at]),
                    "segment": pa.array([data[t][a:b + WIDTH - 1] for t, a, b in
                                         zip(text[at].tolist(), first[at].tolist(), end[at].tolist())], pa.binary())})
    return found.mapInArrow(run, "h bigint, hot boolean, id bigint, th bigint, first bigint, segment binary")


def _hot_spans(hot: DataFrame, shard_segments: int) -> DataFrame:
    """Spans of the segments of split minimizers.

    Equal segments are merged by an aggregate. The rest is sorted in
    sub-shards; each cuts its sorted strings at common splitters (a small
    sample, which only sets how even the ranges are), the runs of a range
    are merged by binary search, and each sub-shard gets its own back.
    """
    spark = hot.sparkSession
    merged = hot.groupBy("h", "segment").agg(F.min("id").alias("id"))
    merged = stored(merged.withColumn("__hash", F.xxhash64("h", "segment")), "merged")
    sub = math.ceil(merged.count() / shard_segments)
    sample = sorted(bytes(r[0]) for r in merged.orderBy("__hash").limit(64 * sub)
                    .select(F.expr(f"substring(segment, 1, {WIDTH})")).collect()) if sub > 1 else []
    cuts = np.array(sample[::64][1:], f"S{WIDTH}")
    merged = merged.withColumn("sub", F.pmod("__hash", F.lit(max(sub, 1))))

    def local(table: pa.Table) -> pa.Table:
        segments = table.column("segment").to_pylist()
        symbols, places, group, _ = string_groups(segments)
        strings = _strings_at(symbols, places)
        least = np.full(len(strings), LAST)
        np.minimum.at(least, group, np.repeat(table.column("id").to_numpy(),
                                              [len(s) - WIDTH + 1 for s in segments]))
        edge = np.concatenate([[0], np.searchsorted(strings, cuts), [len(strings)]])
        pairs = list(zip(edge[:-1].tolist(), edge[1:].tolist()))
        return pa.table({
            "sub": pa.array([table.column("sub")[0].as_py()] * len(pairs), pa.int64()),
            "range": pa.array(range(len(pairs)), pa.int32()),
            "strings": pa.array([strings[a:b].tobytes() for a, b in pairs], pa.binary()),
            "least": pa.array([least[a:b].tobytes() for a, b in pairs], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        runs = [np.frombuffer(x, f"S{WIDTH}") for x in table.column("strings").to_pylist()]
        least = [np.frombuffer(x, np.int64).copy() for x in table.column("least").to_pylist()]
        union = np.unique(np.concatenate(runs))
        best = np.full(len(union), LAST)
        places = [np.searchsorted(union, run) for run in runs]
        for place, own in zip(places, least):
            best[place] = np.minimum(best[place], own)  # a run has each string once
        return pa.table({"sub": table.column("sub"), "range": table.column("range"),
                         "least": pa.array([best[place].tobytes() for place in places], pa.binary())})

    def back(own: pa.Table, found: pa.Table) -> pa.Table:
        segments = own.column("segment").to_pylist()
        _, _, group, begins = string_groups(segments)
        parts = sorted(zip(found.column("range").to_pylist(), found.column("least").to_pylist()))
        least = np.frombuffer(b"".join(x for _, x in parts), np.int64)[group]
        return pa.table({"h": own.column("h"), "segment": own.column("segment"),
                         "least": pa.array(np.split(least, begins[1:]), pa.list_(pa.int64()))})

    runs = merged.groupBy("sub").applyInArrow(
        local, "sub bigint, range int, strings binary, least binary")
    if sub > 1:
        runs = runs.groupBy("range").applyInArrow(merge, "sub bigint, range int, least binary")
    lists = merged.groupBy("sub").cogroup(runs.select("sub", "range", "least").groupBy("sub")).applyInArrow(
        back, "h bigint, segment binary, least array<bigint>")
    def runs_of(batches):
        for batch in batches:
            ids, firsts = batch.column("id").to_numpy(), batch.column("first").to_numpy()
            rows, a, b = [], [], []
            for i, least in enumerate(batch.column("least")):
                x, y = _spans(least.values.to_numpy() < ids[i])
                rows += [i] * len(x)
                a.append(x + firsts[i])
                b.append(y - 1 + firsts[i] + WIDTH)
            at = pa.array(rows, pa.int64())
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id").take(at), "th": batch.column("th").take(at),
                "a": pa.array(np.concatenate([none, *a])), "b": pa.array(np.concatenate([none, *b]))})
    return (hot.join(lists, ["h", "segment"]).select("id", "th", "first", "least")
            .mapInArrow(runs_of, "id bigint, th bigint, a bigint, b bigint"))


def _cut(text: bytes, a: np.ndarray, b: np.ndarray) -> tuple[int, list[tuple[int, int]]]:
    """Removed bytes and the maximal runs of the union of spans."""
    by = np.argsort(a, kind="stable")
    a, b = a[by], b[by]
    reach = np.maximum.accumulate(b)
    new = np.flatnonzero(np.concatenate([[True], a[1:] > reach[:-1]]))
    firsts = a[new]
    ends = reach[np.concatenate([new[1:] - 1, [len(a) - 1]])]
    return int((ends - firsts).sum()), list(zip(firsts.tolist(), ends.tolist()))


def _removed(found: DataFrame, spans: DataFrame, with_text: bool) -> DataFrame:
    """id, th, n_removed, n_spans, kept_sha256 (and kept_text) of texts that lose bytes."""
    gathered = spans.groupBy("id", "th").agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))

    def run(batches):
        for batch in batches:
            counts, runs, digests, kept = [], [], [], []
            for text, a, b in zip(batch.column("text").cast(pa.binary()), batch.column("a"), batch.column("b")):
                data = text.as_py()
                n, own = _cut(data, np.array(a.as_py()), np.array(b.as_py()))
                at, rest = 0, []
                for x, y in own:
                    rest.append(data[at:x])
                    at = y
                left = b"".join([*rest, data[at:]])
                counts.append(n)
                runs.append(len(own))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "th": batch.column("th"), "n_removed": pa.array(counts, pa.int64()),
                 "n_spans": pa.array(runs, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
                | ({"kept_bytes": pa.array(kept, pa.binary())} if with_text else {}))
    cut = (found.select("id", "th", "text").join(gathered, ["id", "th"]).mapInArrow(
        run, "id bigint, th bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
             + ", kept_bytes binary" * with_text))
    return cut.dropDuplicates(["id", "th"])


def remove_repeats(docs: DataFrame, with_text: bool = False, hot_from: int = HOT,
                   shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of ``docs``.

    Bytes covered by a string of 50 bytes that also starts in a document
    with a smaller doc_id are removed; texts are taken as UTF-8 bytes, null
    as empty, and a text of fewer than 50 bytes keeps all. Rows that share a
    doc_id do not remove each other's bytes. A null doc_id counts as larger
    than any other. With ``with_text``, ``kept_bytes`` has what is left (null:
    all). An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
                      F.xxhash64(text).alias("th"), text.alias("text"))
    rows = stored(own.select("doc_id", "id", "th", F.octet_length("text").cast("long").alias("n_bytes"),
                             F.unhex(F.sha2("text", 256)).alias("sha")), "texts")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(1, math.ceil(total * 2 / (SPAN + 1) / RANGE_ANCHORS), min(12, total // 2**23))
    first = stored(rows.groupBy("sha").agg(F.min("id").alias("least"), F.min("th").alias("th")), "first")

    lists = _shared_minimizers(own, ranges, hot_from).join(first.select("th", F.col("least").alias("id")), "th")
    found = stored(own.join(lists, ["th", "id"]).select("id", "th", "text", "keys", "hot", "any_hot"), "found")
    n = found.select(F.sum(F.octet_length("keys").cast("long"))).first()[0] or 0
    shards = n_buckets(spark, n // 8, shard_segments)
    plain = (_segments(found, ranges).where("NOT hot").withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)))
             .select("shard", F.col("h").bitwiseAND(F.lit(0x7FFF)).cast("smallint").alias("g"), "id", "th", "first", "segment")
             .groupBy("shard").applyInArrow(lambda t: _shard_spans(t), "id bigint, th bigint, a bigint, b bigint"))
    hot = stored(_segments(found.where("any_hot"), ranges).where("hot").drop("hot"), "hot")
    spans = plain.union(_hot_spans(hot, shard_segments))
    cut = _removed(found, spans, with_text)

    known = rows.join(first.select("sha", "least"), "sha").join(cut, ["id", "th"], "left")
    copy = (F.col("id") > F.col("least")) & (F.col("n_bytes") >= WIDTH)
    empty = hashlib.sha256(b"").hexdigest()
    columns = [
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256")]
    if with_text:
        columns.append(F.when(copy, F.lit(b"")).otherwise(F.col("kept_bytes")).alias("kept_bytes"))
    return known.select(*columns)
