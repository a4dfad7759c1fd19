"""Language-model scores by prediction by partial matching on bytes.

A trie of byte contexts up to ``ORDER`` bytes long is counted over the
training texts. A byte is predicted from its longest context seen there; an
unseen byte costs an escape (its probability is the number of different
bytes over that number plus all counts) and goes to the next shorter
context, without the bytes that the longer one already had. Below the empty
context all remaining bytes, and the end of the text, are equally likely.
The sum of the logarithms is the code length of a text.

Neither the trie nor the word counts of the baseline are held whole
anywhere. Texts are dealt into blocks; a block sends each part of the trie
(the contexts that end in certain two bytes) the different strings of
ORDER + 1 symbols it has, and the part, which has all counts of these
contexts, sends back one number for each. Contexts of one and no byte are at
most 258 * 258 numbers and go to every task. Counts are merged at most
``FAN_IN`` blocks at a time, so a common context is no bottleneck.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import bounded_batches, n_buckets, stored

ORDER = 5
BITS = 9                      # a symbol: 0 before the text, byte + 1, 257 at its end
END = 257
SYMBOLS = 257                 # that can be predicted
BLOCK_BYTES = 12 << 20
PIECE = 1 << 20
FAN_IN = 256
LOW_ORDERS = -1               # the part that has the contexts of one byte
HELD_OUT = 2                  # crc32(doc_id as text) mod 7

_END_WORD = b"\n"             # no word has white space


def _mask(symbols: int) -> np.int64:
    return np.int64((1 << BITS * symbols) - 1)


def _strings(texts: list[bytes]) -> np.ndarray:
    """A number for each symbol of the texts, end included: its context and itself."""
    pad = bytes(ORDER)
    data = b"".join(pad + t + b"\0" for t in texts)
    symbols = np.frombuffer(data, np.uint8).astype(np.int64) + 1
    sizes = np.array([len(t) for t in texts], np.int64) + ORDER + 1
    ends = np.cumsum(sizes)
    symbols[ends - 1] = END
    starts = ends - sizes
    symbols[(starts[:, None] + np.arange(ORDER)).ravel()] = 0
    n = len(symbols) - ORDER
    key = np.zeros(max(n, 0), np.int64)
    for k in range(ORDER + 1):
        key = (key << BITS) | symbols[k:k + n]
    return key[(key & _mask(1)) != 0]


def _pieces(texts: list[bytes]):
    """Runs (first, end) of texts of about PIECE bytes."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > PIECE:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """By the two symbols before the last."""
    two = ((keys >> BITS) & _mask(2)).astype(np.uint64)
    two = (two + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((two >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _word_part(words: list[bytes], parts: int) -> list[int]:
    return [xxhash.xxh3_64_intdigest(w) % parts for w in words]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    by = np.argsort(keys, kind="stable")
    keys, counts = keys[by], counts[by]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], np.add.reduceat(counts, heads)


def _pack(x: np.ndarray) -> bytes:
    """Sorted numbers as differences: these compress well."""
    return np.diff(x, prepend=np.int64(0)).astype("<i8").tobytes()


def _unpack(x: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(x, "<i8"))


def _tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), _END_WORD]  # bytes: only A-Z are lowered


def _texts(table: pa.Table) -> list[bytes]:
    return [t or b"" for t in table.column("text").cast(pa.large_binary()).to_pylist()]


def _block_strings(texts: list[bytes], train: np.ndarray | None):
    """The block's different strings, sorted, their counts in training texts, and
    for each piece the place of its strings among them."""
    codes, uniques, counts = [], [], []
    for a, b in _pieces(texts):
        keys = _strings(texts[a:b])
        code, unique = pd.factorize(keys)
        uniques.append(unique)
        if train is None:
            codes.append(code.astype(np.int32))
        else:
            weight = np.repeat(train[a:b], [len(t) + 1 for t in texts[a:b]]).astype(np.float64)
            counts.append(np.bincount(code, weights=weight, minlength=len(unique)).astype(np.int64))
    everything = np.unique(np.concatenate([*uniques, np.zeros(0, np.int64)]))
    if train is None:
        return everything, codes, uniques
    total = np.zeros(len(everything), np.int64)
    for unique, count in zip(uniques, counts):
        total[np.searchsorted(everything, unique)] += count
    return everything, total


def _count_block(table: pa.Table, parts: int, word_parts: int) -> pa.Table:
    """Rows (block, kind, part, keys, counts, total) of the strings and words of a block."""
    block = table.column("block")[0].as_py()
    texts = _texts(table)
    train = ~table.column("held_out").to_numpy(zero_copy_only=False)
    keys, counts = _block_strings(texts, train)
    low, low_counts = _summed(keys & _mask(2), counts)
    seen = low_counts > 0
    rows = [("strings", LOW_ORDERS, _pack(low[seen]), low_counts[seen].tobytes(), 0)]
    part = _part(keys, parts)
    by = np.argsort(part, kind="stable")
    part, keys, counts = part[by], keys[by], counts[by]
    edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else [0]
    for a, b in zip(edge[:-1], edge[1:]):
        rows.append(("strings", int(part[a]), _pack(keys[a:b]), counts[a:b].tobytes(), 0))

    known: Counter = Counter()
    every: dict[bytes, None] = {}
    for t, own in zip(texts, train.tolist()):
        words = _tokens(t)
        if own:
            known.update(words)
        else:
            every.update(dict.fromkeys(words))
    every.update(dict.fromkeys(known))
    by_part: dict[int, list[bytes]] = {}
    for w, p in zip(every, _word_part(list(every), word_parts)):
        by_part.setdefault(p, []).append(w)
    for p, words in by_part.items():
        words.sort()
        counts = np.fromiter((known[w] for w in words), np.int64, len(words))
        rows.append(("words", p, b" ".join(words), counts.tobytes(), int(counts.sum())))
    kind, part, keys, counts, total = zip(*rows)
    return pa.table({"block": pa.array([block] * len(rows), pa.int64()), "kind": pa.array(kind),
                     "part": pa.array(part, pa.int64()), "keys": pa.array(keys, pa.binary()),
                     "counts": pa.array(counts, pa.binary()), "total": pa.array(total, pa.int64())})


def _merge(table: pa.Table) -> pa.Table:
    """One row (part, salt, keys, counts) of the training counts of several."""
    keys = np.concatenate([_unpack(x) for x in table.column("keys").to_pylist()])
    counts = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()])
    keys, counts = _summed(keys[counts > 0], counts[counts > 0])
    return pa.table({"part": table.column("part").slice(0, 1), "salt": table.column("salt").slice(0, 1),
                     "keys": pa.array([_pack(keys)], pa.binary()),
                     "counts": pa.array([counts.tobytes()], pa.binary())})


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place in sorted ``keys``, -1 if not there."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class _Order:
    """Counts of the contexts of one length: ``keys`` are context and symbol."""

    def __init__(self, k: int, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.contexts, self.of = np.unique(keys >> BITS, return_inverse=True)
        self.n = np.bincount(self.of, weights=counts, minlength=len(self.contexts))
        self.kinds = np.bincount(self.of, minlength=len(self.contexts)).astype(np.float64)
        self.k = k

    def counted_below(self, below: "_Order") -> np.ndarray:
        """For each context, how often its symbols occur in the context shorter by one."""
        at = _find(below.keys, self.keys & _mask(self.k))
        return np.bincount(self.of, weights=below.counts[at], minlength=len(self.contexts))


class Trie:
    """Log10 probabilities from counted strings that share their last two context
    symbols, and counted strings (context of one symbol) of all texts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, low: np.ndarray, low_counts: np.ndarray):
        self.orders: list[_Order] = []
        for k in range(ORDER + 1):
            own = (keys, counts) if k >= 2 else (low, low_counts)
            self.orders.append(_Order(k, *_summed(own[0] & _mask(k + 1), own[1])))
        self.below = [None] + [self.orders[k].counted_below(self.orders[k - 1]) for k in range(1, ORDER + 1)]

    def log10(self, strings: np.ndarray) -> np.ndarray:
        out = np.zeros(len(strings))
        open_ = np.ones(len(strings), bool)
        excluded = np.zeros(len(strings))   # counts, at this order, of the symbols of the longer context
        had = np.zeros(len(strings))        # how many these are
        for k in range(ORDER, -1, -1):
            o = self.orders[k]
            context = _find(o.contexts, (strings >> BITS) & _mask(k))
            there = open_ & (context >= 0)
            at = _find(o.keys, strings & _mask(k + 1))
            n = np.where(there, o.n[context] if len(o.n) else 0, 0) - excluded
            kinds = np.where(there, o.kinds[context] if len(o.n) else 0, 0) - had
            hit = there & (at >= 0)
            out[hit] += np.log10(o.counts[at[hit]]) - np.log10(n[hit] + kinds[hit])
            escape = there & ~hit & (kinds > 0)
            out[escape] += np.log10(kinds[escape]) - np.log10(n[escape] + kinds[escape])
            open_ &= ~hit
            if k and len(o.n):
                excluded = np.where(there, self.below[k][context], 0)
                had = np.where(there, o.kinds[context], 0)
            elif k == 0:
                had = np.where(there, o.kinds[context] if len(o.n) else 0, 0)
        out[open_] -= np.log10(SYMBOLS - had[open_])
        return out


def _score_part(asked: pa.Table, model: pa.Table, low: tuple[bytes, bytes]) -> pa.Table:
    """block, part and the log10 probability of each of its strings in this part."""
    if not len(asked):
        return pa.table({"block": pa.array([], pa.int64()), "part": pa.array([], pa.int64()),
                         "logs": pa.array([], pa.binary())})
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(model):
        keys = _unpack(model.column("keys")[0].as_py())
        counts = np.frombuffer(model.column("counts")[0].as_py(), np.int64)
    trie = Trie(keys, counts, _unpack(low[0]), np.frombuffer(low[1], np.int64))
    own = [_unpack(x) for x in asked.column("keys").to_pylist()]
    every = np.unique(np.concatenate(own))
    logs = trie.log10(every)
    return pa.table({"block": asked.column("block"), "part": asked.column("part"), "logs": pa.array(
        [logs[np.searchsorted(every, x)].tobytes() for x in own], pa.binary())})


def _count_words(table: pa.Table) -> pa.Table:
    """block, part, the corpus counts of the block's words, and the number of known words."""
    words = [x.split(b" ") for x in table.column("keys").to_pylist()]
    total: dict[bytes, int] = {}
    for own, counts in zip(words, table.column("counts").to_pylist()):
        for w, c in zip(own, np.frombuffer(counts, np.int64).tolist()):
            if c:
                total[w] = total.get(w, 0) + c
    known = [len(total)] + [0] * (len(words) - 1)  # once for the part
    return pa.table({
        "block": table.column("block"), "part": table.column("part"),
        "counts": pa.array([np.fromiter((total.get(w, 0) for w in own), np.int64, len(own)).tobytes()
                            for own in words], pa.binary()), "known": pa.array(known, pa.int64())})


def _score_block(table: pa.Table, found: pa.Table, parts: int, word_parts: int, kind: pa.DataType,
                 train_tokens: int, known_words: int) -> pa.Table:
    texts = _texts(table)
    keys, codes, uniques = _block_strings(texts, None)
    logs = np.zeros(len(keys))
    part = _part(keys, parts)
    by = np.argsort(part, kind="stable")
    edge = np.searchsorted(part[by], np.arange(parts + 1))
    counts: dict[int, np.ndarray] = {}
    for what, p, own in zip(*(found.column(c).to_pylist() for c in ("kind", "part", "numbers"))):
        if what == "strings":
            logs[by[edge[p]:edge[p + 1]]] = np.frombuffer(own, np.float64)
        else:
            counts[p] = np.frombuffer(own, np.int64)
    score = []
    for (a, b), code, unique in zip(_pieces(texts), codes, uniques):
        each = logs[np.searchsorted(keys, unique)][code]
        sizes = np.array([len(t) + 1 for t in texts[a:b]])
        score.append(np.add.reduceat(each, np.cumsum(sizes) - sizes))
    score = np.concatenate([*score, np.zeros(0)])

    every: dict[bytes, None] = {}
    for t in texts:
        every.update(dict.fromkeys(_tokens(t)))
    by_part: dict[int, list[bytes]] = {}
    for w, p in zip(every, _word_part(list(every), word_parts)):
        by_part.setdefault(p, []).append(w)
    count: dict[bytes, int] = {}
    for p, words in by_part.items():
        words.sort()
        count.update(zip(words, counts[p].tolist()))
    n_tokens, n_known, base = [], [], []
    whole = math.log10(train_tokens + known_words + 1)
    for t in texts:
        own = np.fromiter(map(count.__getitem__, _tokens(t)), np.float64)
        n_tokens.append(len(own))
        n_known.append(int((own > 0).sum()))
        base.append(float(np.log10(own + 1).sum() - whole * len(own)))
    return pa.table({
        "doc_id": table.column("doc_id").cast(kind), "held_out": table.column("held_out"),
        "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
        "train_tokens": pa.array([train_tokens] * len(texts), pa.int64()),
        "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64())})


def score_texts(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row.

    Rows whose crc32(doc_id as text) mod 7 is 2 are held out, the model is
    learnt from the others (a null doc_id counts as empty text, so it is
    learnt from). ``base_score`` is the add-one unigram score of the words
    and one end token, ``score`` the log10 probability of the text's bytes
    and its end. A null text is empty: one token, the end. Without training
    rows all symbols are equally likely. Repeated rows count and are scored
    each; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held = (F.crc32(ident.cast("binary")) % 7) == HELD_OUT
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    blocks = n_buckets(spark, total, block_bytes)
    parts = word_parts = blocks
    rows = docs.select("doc_id", held.alias("held_out"), "text",
                       F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"))

    sent = stored(rows.groupBy("block").applyInArrow(
        lambda t: _count_block(t, parts, word_parts),
        "block bigint, kind string, part bigint, keys binary, counts binary, total bigint"), "counts")
    strings, words = sent.where("kind = 'strings'"), sent.where("kind = 'words'")

    groups = math.ceil(blocks / FAN_IN)
    asked = strings.where(f"part <> {LOW_ORDERS}").withColumn("salt", F.pmod("block", F.lit(groups)))
    merged = strings.withColumn("salt", F.pmod("block", F.lit(groups)))
    while True:
        merged = merged.groupBy("part", "salt").applyInArrow(
            _merge, "part bigint, salt bigint, keys binary, counts binary")
        if groups == 1:
            break
        groups = math.ceil(groups / FAN_IN)
        merged = merged.withColumn("salt", F.pmod("salt", F.lit(groups)))
    model = stored(merged.drop("salt"), "trie")
    few = model.where(f"part = {LOW_ORDERS}").select("keys", "counts").first()  # at most 258 * 258 numbers
    low = (bytes(few[0]), bytes(few[1])) if few else (b"", b"")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(math.ceil(blocks / FAN_IN) - 1).cast("long")))
    logs = (asked.groupBy("part", "salt").cogroup(model.withColumn("salt", salts).groupBy("part", "salt"))
            .applyInArrow(lambda a, m: _score_part(a, m, low), "block bigint, part bigint, logs binary"))
    counted = stored(words.groupBy("part").applyInArrow(
        _count_words, "block bigint, part bigint, counts binary, known bigint"), "words")
    train_tokens = words.agg(F.sum("total")).first()[0] or 0
    known_words = counted.agg(F.sum("known")).first()[0] or 0

    numbers = (logs.select("block", F.lit("strings").alias("kind"), "part", F.col("logs").alias("numbers"))
               .union(counted.select("block", F.lit("words"), "part", "counts")))
    kind = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    arrow_kind = to_arrow_type(kind)
    return rows.groupBy("block").cogroup(numbers.groupBy("block")).applyInArrow(
        lambda t, f: _score_block(t, f, parts, word_parts, arrow_kind, train_tokens, known_words),
        f"doc_id {kind.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double")
