"""Quality rules: how much of a text lies in its own repeated n-grams and lines.

Words are mapped to integers, windows of several lengths get a rolling hash
in numpy, and equal hashes within a text (checked against the words) mark
the characters inside duplicated windows. Only windows whose first three
words repeat can repeat at a greater length, so the longer windows are
looked at in few places. Each text is judged alone: one pass, no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tramline.llm.common import bounded_batches, per_text

# ASCII white space that ends a word, symbols that are counted.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))

# Greatest percentage of a text's word characters inside later copies of
# windows of so many words, and of its line characters in later copies of lines.
MAX_NGRAM_PERCENT = {5: 25, 7: 20, 10: 20}
MAX_LINE_CHAR_PERCENT = 25
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(1)) * _MULTIPLIER
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _code_points(data: bytes) -> int:
    return len(data.translate(None, CONTINUATION))


def _repeated(starts: np.ndarray, n: int, codes: np.ndarray, docs: np.ndarray,
              hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ``starts`` (ascending), those whose window of n words occurs twice or
    more in its text, and of these all but the first of each window."""
    starts = starts[starts + n <= len(codes)]
    starts = starts[docs[starts] == docs[starts + n - 1]]
    rolled = np.zeros(len(starts), np.uint64)
    for k in range(n):
        rolled = rolled * _MULTIPLIER + hashes[starts + k]
    rolled ^= _mix(docs[starts].astype(np.uint64))
    # only hashes that occur twice need the slower stable sort
    ordered = np.sort(rolled)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return starts[:0], starts[:0]
    at = np.minimum(np.searchsorted(twice, rolled), len(twice) - 1)
    some = twice[at] == rolled
    starts, rolled = starts[some], rolled[some]
    order = np.argsort(rolled, kind="stable")
    same = _equal(starts[order[:-1]], starts[order[1:]], n, codes, docs)
    if (same != (rolled[order[1:]] == rolled[order[:-1]])).any():  # two windows share a hash
        order = np.lexsort([starts] + [codes[starts + k] for k in range(n)] + [docs[starts]])
        same = _equal(starts[order[:-1]], starts[order[1:]], n, codes, docs)
    later = starts[order[1:][same]]
    return np.union1d(starts[order[:-1][same]], later), later


def _equal(a: np.ndarray, b: np.ndarray, n: int, codes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    same = docs[a] == docs[b]
    for k in range(n):
        same &= codes[a + k] == codes[b + k]
    return same


def _covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which words lie in a window that begins at one of ``starts``."""
    edge = np.bincount(starts, minlength=total + 1) - np.bincount(starts + n, minlength=total + 1)
    return np.cumsum(edge[:total]) > 0


def measure(texts: list[bytes]) -> dict[str, list]:
    """Counts for each text (see ``COLUMNS``)."""
    split = [t.split() for t in texts]
    words = [w for s in split for w in s]
    counts = np.array([len(s) for s in split], np.int64)
    seen = dict.fromkeys(words)
    lengths = np.fromiter(map(_code_points, seen), np.int64, len(seen))
    ids = dict(zip(seen, range(len(seen))))
    codes = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    docs = np.repeat(np.arange(len(texts)), counts)
    hashes = _mix(codes.astype(np.uint64))
    chars = lengths[codes] if len(words) else np.zeros(0, np.int64)

    out: dict[str, list] = {"n_words": counts.tolist()}
    out["word_chars"] = [_code_points(t.translate(None, SPACE)) for t in texts]
    out["n_symbols"] = [len(t) - len(t.translate(None, SYMBOLS)) for t in texts]
    dup_lines, line_chars, dup_line_chars = [], [], []
    for t in texts:
        own = [x for x in t.split(b"\n") if x.strip(SPACE)]
        total = sum(map(_code_points, own))
        once = dict.fromkeys(own)
        dup_lines.append(len(own) - len(once))
        line_chars.append(total)
        dup_line_chars.append(0 if len(own) == len(once) else total - sum(map(_code_points, once)))
    out |= {"n_dup_lines": dup_lines, "line_chars": line_chars,
            "dup_line_chars": dup_line_chars}
    repeats, _ = _repeated(np.arange(len(codes)), 3, codes, docs, hashes)
    inside = _covered(repeats, 3, len(codes))
    out["n_repeat_words"] = np.bincount(docs[inside], minlength=len(texts)).tolist()
    for n in MAX_NGRAM_PERCENT:
        _, later = _repeated(repeats, n, codes, docs, hashes)
        inside = _covered(later, n, len(codes))
        out[f"dup_chars_{n}"] = np.bincount(
            docs[inside], weights=chars[inside], minlength=len(texts)).astype(np.int64).tolist()
    judge(out)
    return out


def judge(m: dict[str, list]) -> None:
    """Adds ``base_failed`` and ``kept``."""
    v = {k: np.array(x, np.int64) for k, x in m.items()}
    failed = (v["n_words"] < MIN_WORDS) | (100 * v["n_repeat_words"] > MAX_REPEAT_PERCENT * v["n_words"])
    bad = 100 * v["dup_line_chars"] > MAX_LINE_CHAR_PERCENT * v["line_chars"]
    for n, percent in MAX_NGRAM_PERCENT.items():
        bad |= 100 * v[f"dup_chars_{n}"] > percent * v["word_chars"]
    m["base_failed"] = failed.tolist()
    m["kept"] = (~failed & ~bad).tolist()


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["line_chars", "dup_line_chars", *(f"dup_chars_{n}" for n in MAX_NGRAM_PERCENT)]
COLUMNS = {**{c: pa.int64() for c in COUNTS}, "base_failed": pa.bool_(), "kept": pa.bool_(),
           **{c: pa.int64() for c in EXTRA}}


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, counts, ``base_failed``, ``kept``.

    A null or empty text has no words and fails the base rule. Repeated rows
    are judged one by one; an empty table gives an empty result. Columns
    other than doc_id and text are not read.
    """
    bounded_batches(docs.sparkSession)
    ddl = ", ".join([f"doc_id {dict(docs.dtypes)['doc_id']}", *(f"{c} bigint" for c in COUNTS),
                     "base_failed boolean, kept boolean", *(f"{c} bigint" for c in EXTRA)])
    return docs.select("doc_id", "text").mapInArrow(per_text(measure, COLUMNS, ["doc_id"]), ddl)


def drop_low_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, all their columns as they were.

    Null and empty texts go (they have no words); repeated rows stay or go
    each; a null doc_id plays no part. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)

    def keep(batches):
        from tramline.llm.common import text_chunks
        for batch in batches:
            for first, texts in text_chunks(batch):
                part = batch.slice(first, len(texts))
                yield part.filter(pa.array(measure(texts)["kept"], pa.bool_()))
    return docs.mapInArrow(keep, docs.schema)
