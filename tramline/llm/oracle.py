"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from tramline.llm import decontaminate as dec
from tramline.llm import filter_audit as fa
from tramline.llm import licenses as lic
from tramline.llm import minhash as mh
from tramline.llm import quality_rules as qr
from tramline.llm import suffix_dedup as sd
from tramline.llm import turn_repair as tr

SQL: dict[str, str] = {}


def _quality_rules() -> str:
    sizes = sorted(qr.MAX_NGRAM_PERCENT)
    grams = ", ".join(
        f"CASE WHEN n - i >= {n - 1} THEN concat_ws(' ', {', '.join(f'lead(w, {k}) OVER p' for k in range(n))}) END AS g{n}"
        for n in (3, *sizes))
    nth = ", ".join(
        f"CASE WHEN g{n} IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY r, g{n}) END AS c{n}, "
        f"CASE WHEN g{n} IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY r, g{n} ORDER BY i) END AS k{n}"
        for n in (3, *sizes))
    back = lambda n: f"OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    inside = ", ".join([f"max(c3) {back(3)} >= 2 AS in3", *(f"max(k{n}) {back(n)} >= 2 AS in{n}" for n in sizes)])
    sums = ", ".join(f"coalesce(sum(length(w)) FILTER (in{n}), 0)::BIGINT AS dup_chars_{n}" for n in sizes)
    bad = " OR ".join([f"100 * dup_line_chars > {qr.MAX_LINE_CHAR_PERCENT} * line_chars",
                       *(f"100 * dup_chars_{n} > {p} * word_chars" for n, p in qr.MAX_NGRAM_PERCENT.items())])
    failed = f"n_words < {qr.MIN_WORDS} OR 100 * n_repeat_words > {qr.MAX_REPEAT_PERCENT} * n_words"
    return rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
w AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i, len(ws) AS n FROM l),
g AS (SELECT r, w, i, {grams} FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, w, i, {nth} FROM g),
h AS (SELECT r, w, {inside} FROM c),
a AS (SELECT r, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars,
             count(*) FILTER (in3) AS n_repeat_words, {sums} FROM h GROUP BY r),
s AS (SELECT r, x, count(*) AS k FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM t)
      WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r, x),
d AS (SELECT r, sum(k - 1)::BIGINT AS n_dup_lines, sum(k * length(x))::BIGINT AS line_chars,
             sum((k - 1) * length(x))::BIGINT AS dup_line_chars FROM s GROUP BY r),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             coalesce(line_chars, 0) AS line_chars, coalesce(dup_line_chars, 0) AS dup_line_chars,
             {", ".join(f"coalesce(dup_chars_{n}, 0) AS dup_chars_{n}" for n in sizes)}
      FROM t LEFT JOIN a USING (r) LEFT JOIN d USING (r))
SELECT *, {failed} AS base_failed, NOT ({failed}) AND NOT ({bad}) AS kept FROM m"""


def _decontaminate() -> str:
    size = dec.WINDOW
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    after = ", ".join(f"lead(w, {k}) OVER p AS w{k}" for k in range(1, size))
    gram = lambda n: f"concat_ws(' ', w, {', '.join(f'w{k}' for k in range(1, n))})" if n > 1 else "w"
    grams = " UNION ALL ".join(
        f"SELECT r, {n} AS n, i, {gram(n)} AS g FROM p WHERE w IN (SELECT w FROM z WHERE n = {n})"
        + (f" AND w{n - 1} IS NOT NULL" if n > 1 else "") for n in range(1, size + 1))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({words}, []) AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {words} AS ws FROM benchmark WHERE text IS NOT NULL),
k AS (SELECT DISTINCT item, least(len(ws), {size}) AS n,
             array_to_string(list_slice(ws, i, i + least(len(ws), {size}) - 1), ' ') AS g
      FROM (SELECT item, ws, unnest(range(1, len(ws) - least(len(ws), {size}) + 2)) AS i FROM b WHERE len(ws) > 0)),
z AS (SELECT DISTINCT n, split_part(g, ' ', 1) AS w FROM k),
u AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
p AS (SELECT r, i, w, {after} FROM u WINDOW p AS (PARTITION BY r ORDER BY i)),
x AS ({grams}),
f AS (SELECT x.r, x.i, x.n, k.item FROM x JOIN k ON x.n = k.n AND x.g = k.g),
h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS j FROM f) GROUP BY r),
m AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM f GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 100 * coalesce(n_hit, 0) >= {dec.MIN_PERCENT} * len(ws) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN m USING (r)"""


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _licenses() -> str:
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    lines = f"regexp_replace(chr(10) || translate(text, {lower}) || chr(10), '\\r\\n?', chr(10), 'g')"
    for pattern, new in ((lic.MARGIN, "\n"), (lic.VERSION, "\\1v \\2"), (lic.NAMED, f"{lic._TAG} "), (lic.QUOTES, " ")):
        lines = f"regexp_replace({lines}, {_quoted(pattern)}, {_quoted(new)}, 'g')"
    clean = "x"
    for pattern, new in ((lic.JUNK, " "), (lic.SPACES, " "), (" ([,.])", "\\1"), ("^ | $|[.,]+ ?$", "")):
        clean = f"regexp_replace({clean}, {_quoted(pattern)}, {_quoted(new)}, 'g')"
    places = ", ".join(
        "CASE WHEN regexp_matches(s, {0}){1} THEN {{{{'at': length(regexp_extract(s, {2}, 1)), 'name': '{3}'}}}} END".format(
            _quoted(p), f" AND NOT regexp_matches(s, {_quoted(u)})" if u else "", _quoted(f"^(.*?)(?:{p})"), n)
        .replace("{{", "{").replace("}}", "}") for n, p, u in lic.KNOWN)
    found = f"list_transform(list_sort(list_filter([{places}], lambda y: y IS NOT NULL)), lambda y: y.name)"
    some = f"CASE WHEN regexp_matches(s, {_quoted(lic.ANY)}) THEN {found} ELSE [] END"
    steps, names = [], []
    for k, (name, parts) in enumerate(lic.RULES):
        wanted = "".join(f",{p}," for p in parts)
        steps.append(f"contains(r{k}, '{wanted}') AS f{k}, replace(r{k}, '{wanted}', ',#,') AS r{k + 1}")
        names.append(f"CASE WHEN f{k} THEN '{name}' END")
    bad = ", ".join(map(_quoted, lic.RESTRICTED))
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
q AS (SELECT r, string_split_regex({lines}, {_quoted(lic.BREAK)}) AS xs FROM t),
c AS (SELECT r, list_filter(list_transform(xs, lambda x: {clean}), lambda s: NOT regexp_matches(s, {_quoted(lic.NOTHING)})) AS ss FROM q),
u AS (SELECT r, unnest(ss) AS s, unnest(range(len(ss))) AS i FROM c),
w AS (SELECT r, i, {some} AS ids FROM u),
i AS (SELECT r, flatten(list(CASE WHEN len(ids) = 0 THEN ['-'] ELSE ids END ORDER BY i)) AS ids FROM w GROUP BY r),
n AS (SELECT doc_id, len(list_filter(coalesce(ids, []), lambda x: x <> '-')) AS n_sentences,
             regexp_replace(regexp_replace(',' || array_to_string(coalesce(ids, []), ',') || ',', '(,-)+,', ',-,', 'g'),
                            '^,(-,)?|(,-)?,$', '', 'g') AS sentences
      FROM t LEFT JOIN i USING (r)),
f AS (SELECT doc_id, n_sentences, sentences, ',' || replace(sentences, ',', ',,') || ',' AS r0, {", ".join(steps)} FROM n),
a AS (SELECT *, list_sort(list_distinct(list_filter([{", ".join(names)}], lambda x: x IS NOT NULL))) AS found FROM f),
g AS (SELECT *, CASE WHEN len(found) > 1 THEN list_filter(found, lambda x: x <> '{lic.ALONE}') ELSE found END AS names FROM a)
SELECT doc_id, n_sentences, sentences, array_to_string(names, ',') AS licenses, list_has_any(names, [{bad}]) AS restricted
FROM g"""


def _near_duplicates() -> str:
    n = mh.SHINGLE
    after = ", ".join(f"lead(w, {k}) OVER p" for k in range(1, n))  # fewer words: the whole text from the first
    return rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
v AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM t),
s AS (SELECT DISTINCT doc_id, g
      FROM (SELECT doc_id, n, i, concat_ws(' ', w, {after}) AS g FROM v WINDOW p AS (PARTITION BY doc_id ORDER BY i))
      WHERE i = 1 OR i <= n - {n - 1}),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n_both FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
e AS (SELECT u, v FROM p JOIN z a ON a.doc_id = u JOIN z b ON b.doc_id = v
      WHERE 100 * n_both >= {mh.PERCENT} * (a.n + b.n - n_both)),
r AS (SELECT doc_id AS start, doc_id AS at FROM z UNION SELECT r.start, e.v FROM r JOIN e ON e.u = r.at),
c AS (SELECT start AS doc_id, min("at") AS component_id FROM r GROUP BY start)
SELECT t.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(c.component_id, t.doc_id) AS component_id,
       t.doc_id = coalesce(c.component_id, t.doc_id) AS kept
FROM t LEFT JOIN z USING (doc_id) LEFT JOIN c USING (doc_id)"""


def _suffix_dedup() -> str:
    n = sd.WIDTH
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
z AS (SELECT r, doc_id, x, unnest(range(0, (length(x) // 2 - {n - 1} + 4095) // 4096)) AS part FROM t WHERE length(x) >= {2 * n}),
c AS (SELECT r, doc_id, part, length(x) // 2 - {n - 1} AS n, substr(x, 8192 * part + 1, {8192 + 2 * n - 2}) AS x FROM z),
w AS (SELECT r, doc_id, 4096 * part + j AS i, substr(x, 2 * j + 1, {2 * n}) AS g
      FROM (SELECT r, doc_id, part, x, unnest(range(0, least(4096, n - 4096 * part))) AS j FROM c)),
m AS (SELECT g, min(doc_id) AS least FROM w GROUP BY g HAVING min(doc_id) <> max(doc_id)),
b AS (SELECT r, i FROM w JOIN m USING (g) WHERE least < doc_id),
s AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {n} THEN 0 ELSE 1 END AS first FROM b),
k AS (SELECT r, i, sum(first) OVER (PARTITION BY r ORDER BY i) AS run FROM s),
u AS (SELECT r, run, min(i) AS a, max(i) + {n} AS b FROM k GROUP BY r, run),
v AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM u),
y AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS reach,
             string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM v JOIN t USING (r) GROUP BY r)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(reach, 0) + 1))) AS kept_sha256
FROM t LEFT JOIN y USING (r)"""


def _filter_audit() -> str:
    words = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
    bit = lambda col: f"instr('{fa.NAMES}', {col}) - 1"
    letters = ", ".join(f"('{x}')" for x in fa.NAMES)
    joins = " ".join(f"JOIN l l{k} ON {' AND '.join(f'l{k}.f <> l{j}.f' for j in range(k))}" for k in range(1, 5))
    marks = fa.MARKS.decode()
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
e AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
b AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT doc_id, part, t, {words} AS ws FROM d),
q AS (SELECT w.part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (len(ws) < {fa.MIN_WORDS})::INT AS a,
             (100 * len(list_distinct(ws)) < {fa.MIN_DISTINCT_PERCENT} * len(ws))::INT AS b,
             (100 * len(regexp_replace(w.t, '[^A-Z]', '', 'g')) > {fa.MAX_CAPITAL_PERCENT} * length(w.t))::INT AS c,
             regexp_matches(w.t, '[{marks}]')::INT AS d,
             coalesce(least < w.doc_id OR (w.doc_id IS NULL AND least IS NOT NULL), false)::INT AS e
      FROM w JOIN e ON e.t = w.t LEFT JOIN b ON b.doc_id = w.doc_id),
m AS (SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS fails, count(*) AS n, sum(good)::BIGINT AS good,
             sum(toxic)::BIGINT AS toxic FROM q GROUP BY ALL),
l AS (SELECT * FROM (VALUES {letters}) AS x(f)),
o AS (SELECT l0.f || l1.f || l2.f || l3.f || l4.f AS filter_order FROM l l0 {joins}),
s AS (SELECT filter_order, step, {bit("substr(filter_order, step, 1)")} AS k,
             list_sum(list_transform(range(1, step), lambda i: 1 << ({bit("substr(filter_order, i::INT, 1)")})))::INT AS before
      FROM (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM o)),
r AS (SELECT part, filter_order, step, k,
             (sum(n) FILTER (fails & coalesce(before, 0) = 0 AND (fails >> k) & 1 = 0))::BIGINT AS kept,
             (sum(n) FILTER (fails & coalesce(before, 0) = 0 AND (fails >> k) & 1 = 1))::BIGINT AS removed,
             (sum(n) FILTER (fails & coalesce(before, 0) <> 0 AND (fails >> k) & 1 = 1))::BIGINT AS redundant,
             (sum(n) FILTER (fails = 1 << k))::BIGINT AS unique_fails,
             (sum(good) FILTER (fails & coalesce(before, 0) = 0 AND (fails >> k) & 1 = 1))::BIGINT AS good_lost,
             (sum(toxic) FILTER (fails & coalesce(before, 0) = 0 AND (fails >> k) & 1 = 1))::BIGINT AS toxic_lost
      FROM m CROSS JOIN s GROUP BY part, filter_order, step, k)
SELECT part, filter_order, step, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, k)::BIGINT AS shapley
FROM r"""


def _turn_repair() -> str:
    none = 50_000_000
    add = lambda x, cost, edit: f"lpad((substr({x}, 1, 8)::INT + {cost})::VARCHAR, 8, '0') || substr({x}, 9) || '{edit}'"
    any_u = "least(s0, ss, sa)"
    stay = lambda x, kind: f"CASE WHEN kind = '{kind}' THEN {add(x, 'stays', 'K')} ELSE {add(x, f'{tr.REROLE} + stays', 'R')} END"
    may = lambda x: f"CASE WHEN must THEN '{none}' ELSE {x} END"
    gone = lambda x: add(x, tr.DELETE, "D")
    return rf"""
WITH RECURSIVE c AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
v AS (SELECT coalesce('=' || conv_id::VARCHAR, '') AS cid, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS x FROM conversations),
h AS (SELECT cid, conv_id, turn, role, text, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(x, ''), lambda y: ascii(y)::BIGINT)),
        lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]))) % 20 AS h FROM v, c),
d AS (SELECT cid, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
             CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text) AS i, substr(role, 1, 1) AS r FROM d),
f AS (SELECT cid, i, turn, role, text, r, CASE WHEN r IN ('s', 'u', 'a') THEN r ELSE 'x' END AS kind,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                  WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 THEN 'd'
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault,
             lag(r) OVER (PARTITION BY cid ORDER BY i) || r NOT IN ('su', 'ua', 'au') AS broken FROM o),
g AS (SELECT cid, i, kind, fault IN ('b', 'd') AS must, CASE fault WHEN 't' THEN {tr.TRUNCATED} ELSE 0 END AS stays FROM f),
p AS (SELECT DISTINCT cid, 0::BIGINT AS i, '00000000' AS s0, '{none}' AS ss, '{none}' AS su, '{none}' AS sa FROM f
      UNION ALL
      SELECT cid, i, {gone("s0")}, least({gone("ss")}, {may(f"CASE WHEN kind = 's' THEN {add('s0', 'stays', 'K')} ELSE '{none}' END")}),
             least({gone("su")}, {may(stay(any_u, "u"))}), least({gone("sa")}, {may(stay("su", "a"))})
      FROM (SELECT cid, i, kind, must, stays, s0, ss, su, least(sa, {add("su", tr.INSERT, "I")}) AS sa
            FROM (SELECT g.cid, g.i, kind, must, stays, s0, ss, least(su, {add(any_u, tr.INSERT, "I")}) AS su, sa
                  FROM p JOIN g ON g.cid = p.cid AND g.i = p.i + 1))),
e AS (SELECT cid, least(s0, sa, {add("su", tr.INSERT, "I")}) AS best
      FROM (SELECT cid, s0, sa, least(su, {add(any_u, tr.INSERT, "I")}) AS su, row_number() OVER (PARTITION BY cid ORDER BY i DESC) AS k
            FROM p) WHERE k = 1),
a AS (SELECT cid, substr(best, 1, 8)::BIGINT AS cost, substr(best, 9) AS audit FROM e),
l AS (SELECT cid, k, edit, sum((edit <> 'I')::INT) OVER (PARTITION BY cid ORDER BY k) AS i,
             sum((edit <> 'D')::INT) OVER (PARTITION BY cid ORDER BY k) AS q, sum((edit <> 'D')::INT) OVER (PARTITION BY cid) AS m
      FROM (SELECT cid, unnest(string_split(audit, '')) AS edit, unnest(range(1, length(audit) + 1)) AS k FROM a WHERE audit <> '')),
w AS (SELECT l.cid, k, CASE WHEN edit = 'K' THEN f.role WHEN (q + m) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
             CASE WHEN edit = 'I' THEN '' ELSE f.text END AS line
      FROM l LEFT JOIN f ON f.cid = l.cid AND f.i = l.i WHERE edit <> 'D'),
t AS (SELECT cid, string_agg(line, chr(10) ORDER BY k) AS repaired FROM w GROUP BY cid),
n AS (SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
             count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
             count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (broken) AS illegal FROM f GROUP BY cid)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT cid, conv_id FROM v) LEFT JOIN n USING (cid) LEFT JOIN a USING (cid) LEFT JOIN t USING (cid)"""


SQL["op11_turn_repair"] = _turn_repair()
SQL["op13_filter_audit"] = _filter_audit()
SQL["op9_suffix_array_dedup"] = _suffix_dedup()
SQL["op3_license_sentences"] = _licenses()
SQL["op4_minhash_dedup"] = _near_duplicates()
SQL["op1_quality_rules"] = _quality_rules()
SQL["op10_decontaminate"] = _decontaminate()
