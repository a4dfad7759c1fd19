"""License scan by recognised sentences and ordered rules.

A text is cut into sentences, each is normalised and the known sentences in
it are named by identifiers, in the order of their places. Licences are then
read from the sequence of identifiers by rules tried in order: a rule names a
licence by identifiers that follow each other, and takes them out of the
sequence, so that a longer rule goes before its parts.

Every known sentence has one of a few words, so a text without any of them
needs no cutting; its result is that of cutting it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNDER = r"(?:released|licensed|distributed|available) under (?:either (?:of )?)?(?:the )?(?:terms of (?:either )?(?:the )?)?"
_LATER = r" ?(?:\(?at your option\)? )?any later version"
_SHARE = r"redistribute (?:it|this program|this software) and or modify it under the terms of the gnu "

# Public licence texts. Identifier and pattern of a part of a normalised sentence.
SENTENCES = [
    ("apache2_ref", _UNDER + r"apache license,? version 2(?:\.0)?"),
    ("apache2_copy", r"you may obtain a copy of the license at"),
    ("apache2_basis", r"distributed on an as is basis, without warranties or conditions of any kind"),
    ("apache2_or", r"(?:mit|expat) license,? or (?:under )?(?:the )?apache license,? version 2(?:\.0)?"),
    ("mit_ref", _UNDER + r"(?:mit|expat) license"),
    ("mit_or", r"apache license,? version 2(?:\.0)?,? or (?:under )?(?:the )?(?:mit|expat) license"),
    ("mit_grant", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit_notice", r"permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software"),
    ("mit_basis", r"the software is provided as is, without warranty of any kind"),
    ("isc_grant", r"permission to use, copy, modify, and(?: or|or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("isc_basis", r"the software is provided as is and the author disclaims all warranties"),
    ("bsd_grant", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd_source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd_binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd_names", r"endorse or promote products derived from this software without specific prior written permission"),
    ("bsd_basis", r"this software is provided by the (?:copyright holders?|authors?|regents)(?: and contributors)? as is"),
    ("zlib_basis", r"this software is provided as-is, without any express or implied warranty"),
    ("zlib_origin", r"the origin of this software must not be misrepresented"),
    ("boost_grant", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"),
    ("boost_ref", r"distributed under the boost software license,? version 1\.0"),
    ("gpl3_ref", r"licensed under the gnu general public license,? (?:version|v) ?3(?:\.0)?"),
    ("gpl2_ref", r"licensed under the gnu general public license,? (?:version|v) ?2(?:\.0)?"),
    ("gpl_redistribute", _SHARE + r"general public license"),
    ("lgpl_redistribute", _SHARE + r"(?:lesser|library) general public license"),
    ("agpl_redistribute", _SHARE + r"affero general public license"),
    ("gpl_later2", r"either version 2 of the license, or" + _LATER),
    ("gpl_later21", r"either version 2\.1 of the license, or" + _LATER),
    ("gpl_later3", r"either version 3 of the license, or" + _LATER),
    ("mpl2_ref", r"subject to the terms of the mozilla public license,? (?:v|version) ?2\.0"),
    ("epl2_ref", r"under the terms of the eclipse public license,? (?:v|version) ?2\.0"),
    ("cc_by_nc4", r"licensed under (?:a creative commons attribution-noncommercial 4\.0|cc by-nc 4\.0)"),
    ("cc_by_sa4", r"licensed under (?:a creative commons attribution-sharealike 4\.0|cc by-sa 4\.0)"),
    ("cc_by4", r"licensed under (?:a creative commons attribution 4\.0|cc by 4\.0)"),
    ("cc0", r"licensed under cc0(?: 1\.0)?"),
    ("unlicense", r"free and unencumbered software released into the public domain"),
    ("proprietary", r"all rights reserved"),
]

# Names that a line "SPDX-License-Identifier: ..." may give; older names in brackets.
SPDX = {
    "Apache-2.0": "", "MIT": "", "BSD-2-Clause": "", "BSD-3-Clause": "", "ISC": "", "Zlib": "", "BSL-1.0": "",
    "GPL-2.0-only": "GPL-2.0", "GPL-2.0-or-later": "GPL-2.0+", "GPL-3.0-only": "GPL-3.0", "GPL-3.0-or-later": "GPL-3.0+",
    "LGPL-2.0-or-later": "LGPL-2.0+", "LGPL-2.1-only": "LGPL-2.1", "LGPL-2.1-or-later": "LGPL-2.1+",
    "LGPL-3.0-only": "LGPL-3.0", "LGPL-3.0-or-later": "LGPL-3.0+", "AGPL-3.0-only": "AGPL-3.0",
    "AGPL-3.0-or-later": "AGPL-3.0+", "MPL-2.0": "", "EPL-2.0": "", "CC-BY-4.0": "", "CC-BY-SA-4.0": "",
    "CC-BY-NC-4.0": "", "CC0-1.0": "", "Unlicense": "",
}

# Licence, identifiers in order; longer rules first.
RULES = [
    ("MIT", ["mit_grant", "mit_notice", "mit_basis"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_names", "bsd_basis"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_basis"]),
    ("Apache-2.0", ["apache2_ref", "apache2_copy", "apache2_basis"]),
    ("GPL-2.0-or-later", ["gpl_redistribute", "gpl_later2"]),
    ("GPL-3.0-or-later", ["gpl_redistribute", "gpl_later3"]),
    ("LGPL-2.0-or-later", ["lgpl_redistribute", "gpl_later2"]),
    ("LGPL-2.1-or-later", ["lgpl_redistribute", "gpl_later21"]),
    ("LGPL-3.0-or-later", ["lgpl_redistribute", "gpl_later3"]),
    ("AGPL-3.0-or-later", ["agpl_redistribute", "gpl_later3"]),
    ("ISC", ["isc_grant", "isc_basis"]),
    ("ISC", ["isc_grant", "mit_basis"]),
    ("Zlib", ["zlib_basis", "-", "zlib_origin"]),
    ("Zlib", ["zlib_basis", "zlib_origin"]),
    ("BSL-1.0", ["boost_grant"]),
    ("BSL-1.0", ["boost_ref"]),
    ("Apache-2.0", ["apache2_ref"]),
    ("Apache-2.0", ["apache2_or"]),
    ("MIT", ["mit_ref"]),
    ("MIT", ["mit_or"]),
    ("GPL-3.0-only", ["gpl3_ref"]),
    ("GPL-2.0-only", ["gpl2_ref"]),
    ("MPL-2.0", ["mpl2_ref"]),
    ("EPL-2.0", ["epl2_ref"]),
    ("CC-BY-NC-4.0", ["cc_by_nc4"]),
    ("CC-BY-SA-4.0", ["cc_by_sa4"]),
    ("CC-BY-4.0", ["cc_by4"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    *((name, [f"spdx_{name}"]) for name in SPDX),
    ("Proprietary", ["proprietary"]),
]
ALONE = "Proprietary"  # notices of open licences reserve all rights too: counts only if no licence is found
# Licences whose texts a corpus for any use should not have.
RESTRICTED = ["CC-BY-NC-4.0", "Proprietary"]

# A known sentence starts at a word and ends before another letter, digit or ".digit".
_START, _END = r"(?:^|[^a-z0-9])", r"(?:[^a-z0-9.]|\.(?:[^0-9]|$)|$)"
_NOT = r"(?:not|never|no longer) (?:be |been |yet |being )?"
_TAG = "spdx-license-identifier"


def _spdx(name: str, old: str) -> str:
    """A name in the expression after the tag, whole."""
    names = "|".join(x.lower().replace(".", r"\.").replace("+", r"\+") for x in (name, old) if x)
    return rf"{_TAG} (?:[a-z0-9.+-]+ (?:or|and) ){{0,9}}(?:{names})(?:[^a-z0-9.+-]|$)"


# Identifier, what a sentence must have, and what it must not have (or nothing).
KNOWN = [(n, f"{_START}(?:{p}){_END}",
          f"{_START}{_NOT}(?:{p}){_END}" + (f"|{p}.*[^a-z]later(?:[^a-z]|$)" if n in ("gpl2_ref", "gpl3_ref") else "")
          if n.endswith("_ref") or n.startswith("cc") else None) for n, p in SENTENCES]
KNOWN += [(f"spdx_{name}", _START + _spdx(name, old), None) for name, old in SPDX.items()]
ANY = "|".join(p for _, p, _ in KNOWN)

# Every known sentence has one of these words, and cutting neither makes nor breaks words.
WORDS = ["licen", "permission", "redistribut", "warrant", "provided", "misrepresented", "unencumbered", "reserved"]

BREAK = r"[.!?;:]+[ \t]*\n|[.!?;:]+[ \t]+|\n[ \t]*\n"   # ends a sentence
JUNK = r"[\"'`()*/#_]|(?:^|\n)[ \t]*[-;%]+"             # marks that say nothing
SPACES = r"[ \t\r\n\f\v]+"
MARGIN = r"\n[ \t/*#;%|<>\"'!-]*"                       # marks of comments before a line's words
QUOTES = r"[“”‘’]"
VERSION = r"(^|[^a-z0-9])v\.[ \t\n]+([0-9])"            # "v. 2.0" ends no sentence
NAMED = _TAG + r":[ \t]*"                               # nor does the tag
NOTHING = r"^(?:(?:and |or )?(?:[0-9]{1,2}|[a-z]))?$"   # between two sentences, or the number of a list


def _sentences(text: Column) -> Column:
    """Normalised sentences: lower case (A-Z), no marks, single spaces."""
    lines = F.regexp_replace(F.concat(F.lit("\n"), text, F.lit("\n")), r"\r\n?", "\n")
    lines = F.regexp_replace(F.regexp_replace(F.regexp_replace(lines, MARGIN, "\n"), VERSION, "$1v $2"), NAMED, f"{_TAG} ")
    cut = F.split(F.regexp_replace(lines, QUOTES, " "), BREAK, -1)
    clean = F.transform(cut, lambda s: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        s, JUNK, " "), SPACES, " "), " ([,.])", "$1"), r"^ | $|[.,]+ ?$", ""))
    return F.filter(clean, lambda s: ~s.rlike(NOTHING))


def _identifiers(sentence: Column) -> Column:
    """Of the known sentences in it, by place; '-' if there is none."""
    def place(pattern: str, unless: str | None) -> Column:
        at = F.regexp_instr(sentence, F.lit(pattern))
        return at if unless is None else F.when((at > 0) & sentence.rlike(unless), 0).otherwise(at)
    places = F.array(*(F.struct(place(p, u).alias("at"), F.lit(n).alias("name")) for n, p, u in KNOWN))
    found = F.transform(F.array_sort(F.filter(places, lambda x: x["at"] > 0)), lambda x: x["name"])
    none = F.array(F.lit("-"))
    return F.when(sentence.rlike(ANY), F.when(F.size(found) > 0, found).otherwise(none)).otherwise(none)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, sentences, licenses, restricted of each row of ``docs``.

    ``sentences`` are the identifiers found, in order, comma-joined (a run of
    unknown sentences between two is one ``-``), ``n_sentences`` their number;
    ``licenses`` the licences of the rules that match, sorted and
    comma-joined. A null or empty text has none. Repeated rows are scanned
    each; an empty table gives no rows; columns other than doc_id and text
    are not read.
    """
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    may = text.rlike("|".join(WORDS))
    ids = F.when(may, F.flatten(F.transform(_sentences(text), _identifiers))).otherwise(F.array().cast("array<string>"))
    named = docs.select("doc_id", ids.alias("ids")).select(
        "doc_id", F.size(F.filter("ids", lambda x: x != "-")).cast("long").alias("n_sentences"),
        F.regexp_replace(F.concat(F.lit(","), F.concat_ws(",", "ids"), F.lit(",")), "(,-)+,", ",-,").alias("line"))
    named = named.withColumn("line", F.regexp_replace("line", "^,(-,)?|(,-)?,$", ""))
    # rules take their identifiers out in order; '#' stands where a licence was found
    state = F.struct(F.concat(F.lit(","), F.replace(F.col("line"), F.lit(","), F.lit(",,")), F.lit(",")).alias("rest"),
                     F.array().cast("array<string>").alias("found"))

    rules = F.array(*(F.struct(F.lit(n).alias("name"), F.lit("".join(f",{p}," for p in ps)).alias("wanted"))
                      for n, ps in RULES))

    def step(s: Column, r: Column) -> Column:
        return F.struct(F.replace(s["rest"], r["wanted"], F.lit(",#,")).alias("rest"),
                        F.when(F.contains(s["rest"], r["wanted"]), F.array_append(s["found"], r["name"]))
                        .otherwise(s["found"]).alias("found"))
    found = F.array_sort(F.array_distinct(F.aggregate(rules, state, step, lambda s: s["found"])))
    found = F.when(F.col("line") == "", F.array().cast("array<string>")).otherwise(found)
    open_ones = F.array_remove(F.col("found"), ALONE)
    return named.withColumn("found", found).withColumn(
        "found", F.when(F.size(open_ones) > 0, open_ones).otherwise(F.col("found"))).select(
        "doc_id", "n_sentences", F.col("line").alias("sentences"), F.concat_ws(",", "found").alias("licenses"),
        F.arrays_overlap("found", F.array(*map(F.lit, RESTRICTED))).alias("restricted"))
