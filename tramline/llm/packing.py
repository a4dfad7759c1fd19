"""Best-fit packing planned on the histogram of lengths.

Texts become token ids, cut into pieces of at most one sequence. Best-fit
decreasing then runs over the counts of the lengths (one number for each
length up to the sequence length, however many documents there are): bins in
the same state are one group, and a plan row says "the pieces of this length
with these ranks go to this run of sequences at this offset". Pieces find
their plan row by joining on their rank within their length.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import bounded_batches, group_rank, n_buckets, stored, text_chunks

SEQUENCE = 2048
END_ID = 0

MAX_CACHED = 500_000     # white-space-free strings and words whose ids a worker remembers
SLICE_BYTES = 2 << 20    # a longer text is tokenized in slices that end at white space

# A lower-case Latin word, the ASCII marks after it (both are tokenized apart), and what else there is.
_PARTS = re.compile("([a-z\xe0-\xf6\xf8-\xff]*)([.,!?;:%$&#*]*)([^ ]*)(?: |$)")
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _byte_letters() -> list[str]:
    """The printable letter that byte-level BPE writes for each byte."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers.

    The tokenizer breaks at white space, so a text's ids are those of its
    white-space-free strings in order; each is encoded once and remembered.
    Within one, a lower-cased Latin word and the marks after it are apart
    too, and as they need no normalising they go to the tokenizer's model
    itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.strings: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {"": b""}
        sample = "Voil\xe0, na\xefve (1) WORDS!\nagain"
        if self.encode([sample.encode()])[0] != np.array(
                self.tokenizer.encode(sample, add_special_tokens=False).ids, "<u4").tobytes():
            raise ValueError("the tokenizer does not lower-case and break at white space")

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        out = []
        for t in texts:
            if len(t) > SLICE_BYTES:
                out.append(b"".join(x for s in _slices(t) for x in self._encode([s])))
            else:
                out.append(t)
        short = [i for i, t in enumerate(texts) if len(t) <= SLICE_BYTES]
        for i, x in zip(short, self._encode([texts[i] for i in short])):
            out[i] = x
        return out

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]
        if len(self.strings) > MAX_CACHED:
            self.strings.clear()
        if len(self.words) > MAX_CACHED:
            self.words = {"": b""}
        new = set().union(*split).difference(self.strings)
        if new:
            self._learn(list(new))
        get = self.strings.__getitem__
        return [b"".join(map(get, s)) for s in split]

    def _learn(self, new: list[bytes]) -> None:
        words, strings = self.words, self.strings
        parts = _PARTS.findall(b" ".join(new).decode().lower())
        plain = {w for w, _, rest in parts if w and not rest}
        plain.update({marks for w, marks, rest in parts if w and not rest})
        for w in plain.difference(words):
            spelt = w if w.isascii() else "".join(map(self.letters.__getitem__, w.encode()))
            words[w] = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        other = []
        for b, (word, marks, rest) in zip(new, parts):
            if rest or not word:
                other.append(b)
            else:
                strings[b] = words[word] + words[marks] if marks else words[word]
        for b, e in zip(other, self.tokenizer.encode_batch_fast([b.decode() for b in other], add_special_tokens=False)):
            strings[b] = array("I", e.ids).tobytes()


def _slices(text: bytes):
    at = 0
    while len(text) - at > SLICE_BYTES:
        m = _SPACE.search(text, at + SLICE_BYTES)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """The pieces of each text: doc_id, piece, start, length, ids_crc32 (and ids)."""
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = Encoder(tokenizer_path)
        for batch in batches:
            ids = batch.column("doc_id")
            for first, texts in text_chunks(batch):
                rows, numbers, starts, data = [], [], [], []
                for i, coded in enumerate(encoder.encode(texts), first):
                    coded += end
                    for k, at in enumerate(range(0, len(coded), 4 * sequence)):
                        rows.append(i)
                        numbers.append(k)
                        starts.append(at // 4)
                        data.append(coded[at:at + 4 * sequence])
                columns = {
                    "doc_id": ids.take(pa.array(rows, pa.int64())), "piece": pa.array(numbers, pa.int32()),
                    "start": pa.array(starts, pa.int64()),
                    "length": pa.array([len(x) // 4 for x in data], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in data], pa.int64())}
                if with_ids:
                    columns["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in data],
                                              pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
             + ", ids array<int>" * with_ids)


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over counts: (length, first rank, pieces, first sequence, offset).

    ``room`` lists the free lengths that occur; ``open_bins`` has, for each,
    runs (first sequence, how many) of sequences with just that much free.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    room: list[int] = []
    open_bins: dict[int, list[tuple[int, int]]] = {}
    used = 0

    def leave(free: int, first: int, n: int) -> None:
        if free:
            if free not in open_bins:
                insort(room, free)
                open_bins[free] = []
            open_bins[free].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(room, length)
            if at < len(room):  # the tightest sequences that have room
                free = room[at]
                first, n = open_bins[free].pop()
                take = min(n, left)
                if take < n:
                    open_bins[free].append((first + take, n - take))
                elif not open_bins[free]:
                    del open_bins[free], room[at]
                rows.append((length, rank, take, first, sequence - free))
                rank, left = rank + take, left - take
                leave(free - length, first, take)
                continue
            each = sequence // length  # new sequences, as many pieces in each as fit
            full, rest = divmod(left, each)
            for n, k in ((full, each), (1, rest)):
                if n and k:
                    for j in range(k):
                        rows.append((length, rank, n, used, j * length))
                        rank += n
                    leave(sequence - k * length, used, n)
                    used += n
            left = 0
    return rows


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row for each piece, with its sequence and its offset there.

    Every document yields at least the end id, a null or empty text just
    that. Only texts longer than a sequence are cut. Rows repeated in
    ``docs`` are packed each for itself; an empty table gives no rows;
    columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer_path, sequence, end_id, with_ids)
                 .withColumn("__row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # <= sequence rows
    rows = plan(counts, sequence)
    planned = spark.createDataFrame(
        rows, "length bigint, first_rank bigint, n bigint, first_sequence bigint, offset bigint")
    buckets = n_buckets(spark, sum(counts.values()))
    ranked = group_rank(cut, ["length"], [F.col("__row")], F.pmod(F.xxhash64("__row"), F.lit(buckets)), "__rank")
    # a row for each run of equal bins that a length fills: set by the lengths (sequence at most), not by the documents
    placed = ranked.join(F.broadcast(planned), (ranked["length"] == planned["length"])
                         & (F.col("__rank") >= F.col("first_rank"))
                         & (F.col("__rank") < F.col("first_rank") + F.col("n")))
    return placed.select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32",
        (F.col("first_sequence") + F.col("__rank") - F.col("first_rank")).alias("sequence_id"),
        "offset", *["ids"] * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids in order, from ``pack(..., with_ids=True)``; a sequence is small.

    An empty table gives no rows; null ids among the documents do not matter.
    """
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]))
        .alias("ids"))
