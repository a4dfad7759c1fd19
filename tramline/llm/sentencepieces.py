"""SentencePiece encoding and decoding for merge-type vocabularies.

A text starts as its characters. An agenda holds every adjacent pair of
symbols whose joined string is a piece, best score first and leftmost among
equals; the head is merged and the two pairs that this makes enter the
agenda, until it is empty. Symbols that are no piece become byte pieces.

Merging never crosses a place where no piece has those two characters side
by side. With white space written as a mark that only ever starts a piece,
a text falls into units (marks and the characters up to the next mark), so a
worker runs the agenda once for each new unit and remembers its ids. The
sentencepiece library then encodes the new units of every Arrow batch, or
whole texts on request, and any difference is an error.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tramline.llm.common import bounded_batches, text_chunks

MARK = "▁"          # what stands for a space
MAX_CACHED = 600_000     # units whose ids a worker remembers
SHORT = 24               # symbols up to which the agenda is a plain list
SLICE_CHARS = 1 << 20    # so much of a text is cut into units at a time

# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

NEVER = float("inf")


def _units(pieces: list[str]) -> tuple[re.Pattern, str | None]:
    """What cuts a text where no piece goes on, and a character that always stands alone.

    A mark starts a unit after any other character. ASCII characters that are
    in no longer piece stand alone. ASCII punctuation starts a unit after a
    letter or digit, but where some piece has the two.
    """
    longer = [p for p in pieces if len(p) > 1]
    used = set("".join(longer))
    alone = [chr(c) for c in range(128) if c != 32 and chr(c) not in used]
    points = {c for c in map(chr, range(33, 127)) if not c.isalnum()} - {*alone}
    odd = {(p[i], p[i + 1]) for p in longer for i in range(len(p) - 1)
           if p[i + 1] in points and p[i] not in points and p[i] != MARK}
    text = lambda cs: "".join(map(re.escape, sorted(cs)))
    word, point = f"[^{MARK}{text(alone)}{text(points)}]++", f"[{text(points)}]*+"
    letters, marked = {x for x, _ in odd if x.isalnum()}, {y for x, y in odd if x.isalnum()}
    on = [f"(?<=[{text(letters)}])[{text(marked)}]"] if letters else []
    on += [rf"(?<![^\W_])[{text({y for _, y in odd})}]"] if odd else []
    body = f"{point}(?:{word}(?:(?:{'|'.join(on)}){point})?+)*+" if on else f"{point}(?:{word})?+"
    unit = f"{MARK}++{body}|(?=[^{text(alone)}]){body}" + f"|[{text(alone)}]" * bool(alone)
    return re.compile(unit), alone[0] if alone else None


class Vocabulary:
    """Encodes and decodes with one merge-type model file.

    Supported: no character normalisation, a space put before the text, white
    space kept as it is, byte fallback. Others are refused, as are
    user-defined and unused pieces.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as files
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = files.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        rules, trainer = model.normalizer_spec, model.trainer_spec
        if (trainer.model_type != 2 or rules.precompiled_charsmap or not rules.add_dummy_prefix
                or rules.remove_extra_whitespaces or not rules.escape_whitespaces or not trainer.byte_fallback
                or trainer.treat_whitespace_as_suffix):
            raise ValueError("a merge-type model is needed that leaves characters alone and falls back to bytes")
        if {p.type for p in model.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        normal = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type == NORMAL]
        if any(MARK in p.lstrip(MARK) for _, p, _ in normal):
            raise ValueError("pieces that go on after a space are not supported")
        self.order = {p: -score for _, p, score in normal}  # lowest first
        self.one = {p: np.array([i], "<u4").tobytes() for i, p, _ in normal}
        byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.bytes = [np.array([byte_ids[b]], "<u4").tobytes() for b in range(256)]
        self.begin = np.array([trainer.bos_id], "<u4").tobytes()
        self.end = np.array([trainer.eos_id], "<u4").tobytes()
        self.units, self.apart = _units([p for _, p, _ in normal])
        surface = [b"" if p.type == CONTROL else trainer.unk_surface.encode() if p.type == UNKNOWN
                   else bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.replace(MARK, " ").encode()
                   for p in model.pieces]
        self.surface = pa.array(surface, pa.large_binary())
        self.silent = np.array([p.type == CONTROL for p in model.pieces])
        self.spaced = np.array([p.type == NORMAL and p.piece.startswith(MARK) for p in model.pieces])
        self.known: dict[str, bytes] = {}

    def agenda(self, unit: str) -> bytes:
        """The ids of a unit, by merging the best adjacent pair until none is left."""
        one, spell = self.one, self.bytes
        symbols = self._short(unit) if len(unit) <= SHORT else self._long(unit)
        return b"".join([one[s] if s in one else b"".join([spell[b] for b in s.encode()]) for s in symbols])

    def _short(self, unit: str) -> list[str]:
        """The agenda as a list by place: few pairs are searched faster than kept in a heap."""
        symbols, place = list(unit), self.order.get
        agenda = [place(a + b, NEVER) for a, b in zip(unit, unit[1:])]
        while agenda and (best := min(agenda)) != NEVER:
            i = agenda.index(best)
            del agenda[i]
            symbols[i] += symbols.pop(i + 1)
            if i:
                agenda[i - 1] = place(symbols[i - 1] + symbols[i], NEVER)
            if i < len(agenda):
                agenda[i] = place(symbols[i] + symbols[i + 1], NEVER)
        return symbols

    def _long(self, unit: str) -> list[str]:
        """The agenda as a heap, its entries dropped when one of their symbols has been merged since."""
        order = self.order
        symbols: list[str | None] = list(unit)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(order[p], i, p) for i, p in enumerate(map("".join, zip(unit, unit[1:]))) if p in order]
        heapq.heapify(agenda)
        while agenda:
            _, i, piece = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] is None or j == n or symbols[i] + symbols[j] != piece:
                continue
            symbols[i], symbols[j] = piece, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (pair := piece + symbols[k]) in order:
                    heapq.heappush(agenda, (order[pair], i, pair))
            h = before[i]
            if h >= 0 and (pair := symbols[h] + piece) in order:
                heapq.heappush(agenda, (order[pair], h, pair))
        return [s for s in symbols if s is not None]

    def encode(self, texts: list[str], checked: str | None = "units") -> list[bytes]:
        """Each text's ids with begin and end, as little-endian unsigned 32-bit numbers.

        ``checked``: "units" compares the units not met before with the
        library, "texts" all whole texts, None nothing.
        """
        out = [self.begin + b"".join(self._parts(t, checked == "units")) + self.end for t in texts]
        if checked == "texts":
            wanted = self.library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
            for t, ids, x in zip(texts, wanted, out):
                if np.array(ids, "<u4").tobytes() != x:
                    raise AssertionError(f"other ids than the library's: {t[:80]!r}")
        return out

    def _parts(self, text: str, check: bool) -> Iterator[bytes]:
        if not text:
            return
        text = MARK + text.replace(" ", MARK)
        at, end = 0, 0
        while at < len(text):  # slices end before a mark that follows another character
            end = len(text)
            if end - at > 2 * SLICE_CHARS:
                cut = at + SLICE_CHARS
                while (cut := text.find(MARK, cut)) > 0 and text[cut - 1] == MARK:
                    cut += 1
                end = cut if cut > 0 else end
            found = self.units.findall(text, at, end)
            new = set(found).difference(self.known)
            if new:
                if len(self.known) + len(new) > MAX_CACHED:  # the older half goes
                    keep = list(self.known.items())[len(self.known) // 2:]
                    self.known = dict(keep[max(0, len(keep) + len(new) - MAX_CACHED):])
                    new = set(found).difference(self.known)
                self.known.update(zip(new, map(self.agenda, new)))
                if check:
                    self._compare(new)
            yield b"".join(map(self.known.__getitem__, found))
            at = end

    def _compare(self, units: Iterable[str]) -> None:
        """The library puts the first mark before a text itself; a unit without one goes after a character that stands alone."""
        whole = [u for u in units if u[0] == MARK and len(u) > 1]
        rest = [u for u in units if u[0] != MARK]
        lead = f"{MARK}{self.apart}"
        texts = [u[1:].replace(MARK, " ") for u in whole] + [self.apart + u for u in rest]
        skip = len(self.agenda(lead)) if rest else 0
        for u, ids, off in zip(whole + rest, self.library.encode(texts, num_threads=1), [0] * len(whole) + [skip] * len(rest)):
            if np.array(ids, "<u4").tobytes()[off:] != self.known[u]:
                raise AssertionError(f"other ids than the library's: {u[:80]!r}")

    def decode(self, ids: bytes) -> bytes:
        """The text of ids (little-endian unsigned 32-bit numbers) as UTF-8.

        Joins the pieces' strings, without the space put before the text.
        Byte pieces that form no valid UTF-8 are left to the library.
        """
        numbers = np.frombuffer(ids, "<u4")
        numbers = numbers[~self.silent[numbers]]
        if not len(numbers):
            return b""
        joined = self.surface.take(pa.array(numbers))
        low, high = (int(x) for x in np.frombuffer(joined.buffers()[1], np.int64)[[0, len(numbers)]])
        text = joined.buffers()[2][low:high].to_pybytes()
        if self.spaced[numbers[0]]:
            text = text[1:]
        try:
            text.decode()
        except UnicodeDecodeError:
            text = self.library.decode(np.frombuffer(ids, "<u4").tolist()).encode()
        return text


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """A worker's vocabulary: the units that it knows outlive a task."""
    return Vocabulary(path)


def encode_texts(docs: DataFrame, model_path: str, checked: str | None = "units",
                 with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """One row for each document: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded).

    The ids are those of the whole text with begin and end; the decoded text
    comes from the ids alone. A null or empty text has the two ends and
    decodes to nothing. Repeated rows and null ids give a row each, an empty
    table none; columns other than doc_id and text are not read. One unit
    (text without a space) is held with its agenda, about 400 bytes a character.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(model_path)
        sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs])
        for batch in batches:
            for first, texts in text_chunks(batch):
                ids = known.encode([t.decode("utf-8", "replace") for t in texts], checked)
                back = [known.decode(x) for x in ids]
                columns = {"doc_id": batch.column("doc_id").slice(first, len(texts)),
                           "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                           "ids_sha256": sha(ids), "decoded_sha256": sha(back)}
                if with_ids:
                    columns["ids"] = pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32()))
                if with_text:
                    columns["decoded"] = pa.array([x.decode() for x in back], pa.string())
                yield pa.RecordBatch.from_pydict(columns)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
             + ", ids array<int>" * with_ids + ", decoded string" * with_text)
