"""Personal data: rule matches, widened by bootstrapped contextual extraction.

Rules find e-mail addresses, IP addresses, card and phone numbers. These,
and strings of an unmistakable secret's shape, are the seeds. What stands
before a seed (its last words, and a key such as ``password=`` in the same
string) is a lexical pattern; every string with a digit, an at sign or a key
is a candidate instance of the patterns it stands in. The graph of patterns and
instances is scored in rounds: a pattern is as good as the share of its
instances that are sure, an instance as good as its patterns together. The
instances of sure patterns become sure, and so on. Instances found that no
rule matched are added to the spans.

Everything is DataFrame functions. Texts are scanned once, long ones in
slices that no match can cross, so that time grows with the text; the graph
has short strings only and is summed with partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import stored

KINDS = ["email", "ip", "card", "phone", "secret"]  # in this order at the same start

# The rules, written so that each part takes all it can and gives nothing
# back, and none starts where the run of characters before could have: the
# same matches, in time that grows with the text.
_LOCAL = "A-Za-z0-9._%+-"
RULES = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"  # gives back one zero: a part may be just 0
_SPACE = r"\x20\x09-\x0D"
CANDIDATE = rf"(?<![^{_SPACE}])[^{_SPACE}0-9@=:]*+[0-9@=:][^{_SPACE}]*+"

# A slice ends at white space after a letter, or at a line's end: no rule's match has either.
SLICE_CHARS = 8000
SLICES = rf"(?s).{{{SLICE_CHARS}}}.*?(?:\n|[A-Za-z][{_SPACE}])|.+"

# Seeds besides the rules: keys of a fixed prefix and length, and long strings of hexadecimal digits.
SECRET_SEED = r"^(?:AKIA[0-9A-Z]{16}|(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{16,})$"
KEY = "^([^=:\"'(<\\[]*[=:\"'(<\\[]+)"             # of a candidate: up to its first mark of these
TAIL = "[.,;:!?\"')>\\]]+$"
CONTEXT_CHARS = 48

ROUNDS = 3
MIN_SUPPORT = 3       # sure instances that a pattern needs
MIN_SHARE = 0.6       # of a pattern's instances that must be sure
MIN_SCORE = 0.6       # of an instance that becomes sure
MIN_FOUND_CHARS = 6


def _places(df: DataFrame, text: Column, name: str, rule: str, wanted: Column) -> DataFrame:
    """Adds ``name``: array of (a, m) with the place and the string of each match of ``rule``.

    A match begins after the gaps and matches before it. Sums go by 256, so
    that a text with very many matches takes little longer for each.
    """
    g, m, c = f"__{name}_g", f"__{name}_m", f"__{name}_c"
    source = F.when(wanted, text).otherwise(F.lit(""))
    df = df.withColumn(m, F.regexp_extract_all(source, F.lit(rule), F.lit(0)))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.transform(F.split(text, rule, -1), F.length))
                       .otherwise(F.array().cast("array<int>")))
    both = f"zip_with({g}, {m}, (x, y) -> x + coalesce(length(y), 0))"
    df = df.withColumn(f"{c}l", F.expr(both))
    df = df.withColumn(c, F.expr(
        f"transform(sequence(0, size({m}) div 256), k -> aggregate(slice({c}l, k * 256 + 1, 256), 0, (s, x) -> s + x))"))
    start = (f"aggregate(slice({c}, 1, i div 256), 0, (s, x) -> s + x) + "
             f"aggregate(slice({c}l, (i div 256) * 256 + 1, i % 256), 0, (s, x) -> s + x) + {g}[i]")
    return df.withColumn(name, F.expr(f"transform({m}, (x, i) -> struct({start} AS a, x AS m))")).drop(
        g, m, c, f"{c}l")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled, divides by ten."""
    d = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(i % 2 == 0, twice).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


_CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^(?:{_BYTE}\.){{3}}{_BYTE}$"),
    "card": lambda m: F.when(F.length(_digits(m)).between(12, 19), _luhn(_digits(m))).otherwise(F.lit(False)),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def _slices(text: Column) -> Column:
    """The text in pieces of about SLICE_CHARS that no match crosses."""
    return F.when(F.length(text) > 2 * SLICE_CHARS, F.regexp_extract_all(text, F.lit(SLICES), F.lit(0))).otherwise(F.array(text))


def _scan(docs: DataFrame) -> DataFrame:
    """One row for each slice: doc_id, row, key (of the row), n (slices), at (the slice's first place),
    base spans (a, b, k, m) and mentions, by their places in the whole text."""
    whole = F.coalesce(F.col("text"), F.lit(""))
    parts = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), _row_key(whole).alias("key"),
                        _slices(whole).alias("__slices"))
    ends = F.aggregate("__slices", F.array(F.lit(0)), lambda all_, s: F.array_append(all_, F.element_at(all_, -1) + F.length(s)))
    parts = parts.withColumn("__ends", F.when(F.size("__slices") > 1, ends).otherwise(F.array(F.lit(0))))
    last = lambda i: F.when(i > 0, F.right(F.col("__slices")[i - 1], F.lit(CONTEXT_CHARS))).otherwise("")
    each = F.transform("__slices", lambda s, i: F.struct(F.col("__ends")[i].alias("at"), last(i).alias("__last"), s.alias("__text")))
    df = parts.select("doc_id", "row", "key", F.size("__slices").alias("n"), F.inline(each))
    t = F.col("__text")
    for kind in RULES:
        need = t.contains(NEEDS[kind]) if NEEDS[kind] else F.lit(True)
        digits = F.lit(True) if kind == "email" else t.rlike("[0-9]")
        df = _places(df, t, kind, RULES[kind], need & digits)
    df = _places(df, t, "candidate", CANDIDATE, t.rlike("[0-9@=:]"))

    def spans(kind: str) -> Column:
        return F.transform(F.filter(kind, lambda x: _CHECKS[kind](x["m"])), lambda x: F.struct(
            x["a"].alias("a"), (x["a"] + F.length(x["m"])).alias("b"),
            F.lit(KINDS.index(kind)).alias("k"), x["m"].alias("m")))
    base = F.array_sort(F.concat(*(spans(k) for k in RULES)))
    df = df.withColumn("base", base).drop(*RULES)

    # a candidate: its key, then its value without the marks behind it
    def value(x: Column) -> Column:
        key = F.regexp_extract(x["m"], KEY, 1)
        rest = F.regexp_replace(F.substr(x["m"], F.length(key) + 1), TAIL, "")
        return F.struct((x["a"] + F.length(key)).alias("a"), key.alias("key"), rest.alias("m"))
    values = F.filter(F.transform("candidate", value), lambda x: F.length(x["m"]) >= MIN_FOUND_CHARS)
    free = F.filter(values, lambda x: ~F.exists(
        "base", lambda s: (s["a"] < x["a"] + F.length(x["m"])) & (x["a"] < s["b"])))

    def mention(a: Column, key: Column, m: Column, k: Column) -> Column:
        at = a - F.length(key)
        before = F.substr(F.col("__text"), F.greatest(at - CONTEXT_CHARS + 1, F.lit(1)), F.least(at, F.lit(CONTEXT_CHARS)))
        before = F.when(at < CONTEXT_CHARS, F.right(F.concat("__last", before), F.lit(CONTEXT_CHARS))).otherwise(before)
        words = F.regexp_replace(F.lower(F.regexp_extract(
            before, rf"((?:[^{_SPACE}]+[{_SPACE}]+)?[^{_SPACE}]+[{_SPACE}]*)$", 1)), "[0-9]", "0")
        return F.struct((F.col("at") + a).alias("a"), (F.col("at") + a + F.length(m)).alias("b"), m.alias("m"), k.alias("k"),
                        F.trim(words).alias("words"), F.lower(key).alias("prefix"))
    seeds = F.transform("base", lambda s: mention(s["a"], F.lit(""), s["m"], s["k"]))
    others = F.transform("free", lambda x: mention(
        x["a"], x["key"], x["m"], F.when(x["m"].rlike(SECRET_SEED), F.lit(KINDS.index("secret"))).cast("int")))
    placed = F.transform("base", lambda s: F.struct((F.col("at") + s["a"]).alias("a"), (F.col("at") + s["b"]).alias("b"),
                                                    s["k"].alias("k")))
    return (df.withColumn("free", free).withColumn("mentions", F.concat(seeds, others))
            .select("doc_id", "row", "key", "n", "at", placed.alias("base"), "mentions"))


def _row_key(text: Column) -> Column:
    """Stands for a row: two hashes of its id and text."""
    return F.struct(F.xxhash64("doc_id", text).alias("x"),
                    F.xxhash64(text, F.col("doc_id"), F.lit(1)).alias("y"))


def _patterns(mentions: DataFrame) -> DataFrame:
    """Each mention with the patterns it stands in: key alone, with one and with two words before."""
    last = F.element_at(F.split("words", rf"[{_SPACE}]+"), -1)
    has_key = F.col("prefix").rlike("[a-z]")
    options = F.array_distinct(F.array_compact(F.array(
        F.when(has_key, F.concat(F.lit("0:"), "prefix")),
        F.when(last != "", F.concat(F.lit("1:"), last, F.lit(" "), "prefix")),
        F.when((F.col("words") != "") & (F.col("words") != last),
               F.concat(F.lit("2:"), F.regexp_replace("words", rf"[{_SPACE}]+", " "), F.lit(" "), "prefix")))))
    return mentions.withColumn("pattern", F.explode(options))


def _score(edges: DataFrame) -> DataFrame:
    """pattern, kind and confidence of the sure patterns after the rounds.

    ``edges``: pattern, instance (distinct), k (kind of a seed or null).
    """
    sure = edges.where("k IS NOT NULL").groupBy("instance").agg(F.min("k").alias("kind"))
    found = None
    for i in range(ROUNDS):
        known = edges.select("pattern", "instance").join(sure, "instance", "left")
        by_kind = known.groupBy("pattern", "kind").agg(F.count("*").alias("n"))
        best = F.max(F.when(F.col("kind").isNotNull(), F.struct("n", (-F.col("kind")).alias("k"))))
        good = (by_kind.groupBy("pattern").agg(F.sum("n").alias("total"), best.alias("best"))
                .select("pattern", (-F.col("best.k")).cast("int").alias("kind"), F.col("best.n").alias("n"),
                        (F.col("best.n") / F.col("total")).alias("share"))
                .where((F.col("n") >= MIN_SUPPORT) & (F.col("share") >= MIN_SHARE)))
        found = stored(good.select("pattern", "kind", "share"), f"patterns{i}")
        # an instance is as sure as its patterns together
        scores = (edges.join(found, "pattern").groupBy("instance")
                  .agg(F.sum(F.log1p(-F.least("share", F.lit(0.999)))).alias("doubt"), F.min("kind").alias("kind"))
                  .where(1 - F.exp("doubt") >= MIN_SCORE).select("instance", "kind"))
        sure = stored(sure.union(scores).groupBy("instance").agg(F.min("kind").alias("kind")), f"sure{i}")
    return found


def _found(rows: DataFrame) -> DataFrame:
    """key, at and spans (a, b, k) that the patterns add, one row for each slice with any."""
    mentions = rows.select("key", "at", F.explode("mentions").alias("x")).select("key", "at", "x.*")
    at = _patterns(mentions)
    edges = stored(at.groupBy("pattern", F.sha2("m", 256).alias("instance")).agg(F.min("k").alias("k")), "edges")
    good = _score(edges)
    rule = KINDS.index("secret")
    added = (at.where(f"k IS NULL OR k = {rule}").join(good, "pattern", "left")
             .groupBy("key", "at", "a", "b").agg(F.min(F.coalesce("kind", "k")).alias("k")).where("k IS NOT NULL"))
    loose = mentions.where(f"k = {rule}").select("key", "at", "a", "b", "k")  # seeds without any context
    return (added.select("key", "at", "a", "b", "k").union(loose).groupBy("key", "at", "a", "b").agg(F.min("k").alias("k"))
            .groupBy("key", "at").agg(F.array_sort(F.collect_list(F.struct("a", "b", "k"))).alias("added")))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["k"] + 1), s["a"].cast("string"), s["b"].cast("string"))))


def _ordered(spans: Column) -> Column:
    """By start, then kind."""
    by = F.array_sort(F.transform(spans, lambda s: F.struct(s["a"].alias("a"), s["k"].alias("k"), s["b"].alias("b"))))
    return by


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of each row of ``docs``.

    The counts and base_sha256 are of the rules' spans; ``spans`` also has
    those that the patterns found, of the kind ``secret`` or a rule's.
    Places are code points, end exclusive. A null text is empty and has no
    span. Rows are told apart by doc_id and text; repeated rows get the same
    spans each, and a null doc_id is a value like others. An empty table
    gives no rows; other columns are not read.
    """
    rows = stored(_scan(docs), "mentions")
    every = F.array_distinct(F.concat("base", F.coalesce("added", F.array().cast(SPANS))))
    both = rows.join(_found(rows), ["key", "at"], "left").select("doc_id", "row", "n", "base", every.alias("every"))
    long = both.where("n > 1").groupBy("row").agg(F.first("doc_id").alias("doc_id"), *(
        F.flatten(F.collect_list(c)).alias(c) for c in ("base", "every")))  # the spans of one document
    both = both.where("n = 1").select("doc_id", "base", "every").unionByName(long.select("doc_id", "base", "every"))
    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return both.select("doc_id", *map(count, range(len(RULES))),
                       F.sha2(_written(_ordered(F.col("base"))), 256).alias("base_sha256"),
                       _written(_ordered(F.col("every"))).alias("spans"))


SPANS = "array<struct<a:int,b:int,k:int>>"


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with ``<EMAIL>``, ``<IP>`` and so on in the place of the spans found.

    Overlapping spans become one, named for the first. ``n_chars``, where
    there is such a number, follows the new text; other columns, whatever
    their names, and texts without spans, null texts among them, stay as they
    are. Repeated rows are changed alike; an empty table stays empty.
    """
    rows = stored(_scan(docs), "mentions")
    every = F.concat("base", F.coalesce("added", F.array().cast(SPANS)))
    spans = (rows.join(_found(rows), ["key", "at"], "left").select("key", "at", _ordered(every).alias("spans"))
             .where(F.size("spans") > 0).dropDuplicates(["key", "at"])
             .groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("at", "spans"))).alias("spans")))
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own")
    text = F.coalesce(F.col("text"), F.lit(""))
    joined = docs.select(own, _row_key(text).alias("key")).join(spans, "key", "left")
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))

    def cut(slice_: Column, at: Column) -> Column:
        """A slice: its gaps and the names of its spans, nothing for a span inside the one before."""
        def step(state: Column, s: Column) -> Column:
            first = s["a"] - at
            piece = F.concat(F.substr(slice_, state["to"] + 1, first - state["to"]), F.element_at(names, s["k"] + 1))
            return F.struct(F.when(first < state["to"], state["out"]).otherwise(F.concat(state["out"], piece)).alias("out"),
                            F.greatest(state["to"], s["b"] - at).alias("to"))
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("to"))
        return F.aggregate(F.coalesce(F.col("spans")[at], F.array().cast("array<struct<a:int,k:int,b:int>>")), start, step,
                           lambda s: F.concat(s["out"], F.substr(slice_, s["to"] + 1)))
    slices = _slices(F.col("own.text"))
    ends = F.aggregate("slices", F.array(F.lit(0)), lambda all_, s: F.array_append(all_, F.element_at(all_, -1) + F.length(s)))
    new = F.array_join(F.transform("slices", lambda s, i: cut(s, F.element_at("ends", i + 1))), "")
    out = (joined.withColumn("slices", F.when(F.col("spans").isNotNull(), slices)).withColumn("ends", ends)
           .withColumn("new", F.when(F.col("spans").isNull(), F.col("own.text")).otherwise(new)))
    columns = []
    for f in docs.schema.fields:
        if f.name == "text":
            columns.append(F.col("new").alias("text"))
        elif f.name == "n_chars" and f.dataType.typeName() in ("long", "integer"):
            columns.append(F.when(F.col("spans").isNull(), F.col("own.n_chars"))
                           .otherwise(F.length("new")).cast(f.dataType).alias("n_chars"))
        else:
            columns.append(F.col("own")[f.name].alias(f.name))
    return out.select(*columns)
