"""Licences in texts: sentences are normalised, mapped to known licence sentences, and their sequence is read by ordered rules."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfspark.llm.common import column

#: A sentence ends at a full stop, exclamation or question mark or semicolon before white space, or at a blank line; licences
#: are wrapped, so a line end alone ends nothing.
SENTENCE_END = r"[.!?;]+[\x20\x09-\x0D]+|[\x0A\x0D][\x20\x09\x0B\x0C]*[\x0A\x0D][\x20\x09-\x0D]*"
#: What makes an unknown sentence sound like a licence; known sentences need none of it.
CRITICAL = (
    r"(?i)licen[cs]|copyright|copyleft|spdx|warrant|permi(t|ssion)|redistribut|public domain|as is|liab(le|ility)|"
    r"all rights reserved|creative commons|cc[ -]by|cc0|gpl|endorse|any later version|hope that it will be useful"
)

# Known licence sentences as identifier and pattern on the normalised sentence, more special ones first.
SENTENCES = [
    ("SPDX", r"spdx license identifier [a-z0-9. +-]+"),
    ("GplNoWarranty", r"distributed in the hope that it will be useful"),
    ("GplCopy", r"you should have received a copy of the gnu"),
    ("AGPL3plus", r"gnu affero general public license\b.*\b(version|v) ?3\b.*any later version"),
    ("LGPL3plus", r"gnu lesser general public license\b.*\b(version|v) ?3\b.*any later version"),
    ("LGPL21plus", r"gnu lesser general public license\b.*\b(version|v) ?2\.1\b.*any later version"),
    ("GPL3plus", r"gnu general public license\b.*\b(version|v) ?3\b.*any later version"),
    ("GPL2plus", r"gnu general public license\b.*\b(version|v) ?2\b.*any later version"),
    ("AGPL3", r"gnu affero general public license (as published by the free software foundation )?(,? ?(either )?version|v) ?3"),
    ("LGPL3", r"gnu lesser general public license (as published by the free software foundation )?(,? ?(either )?version|v) ?3"),
    ("LGPL21", r"gnu lesser general public license (as published by the free software foundation )?(,? ?(either )?version|v) ?2\.1"),
    ("GPL3", r"(gnu general public license|gpl) ?(as published by the free software foundation )?(,? ?(either )?version|v) ?3"),
    ("GPL2", r"(gnu general public license|gpl) ?(as published by the free software foundation )?(,? ?(either )?version|v) ?2"),
    ("GPLany", r"(gnu general public license|\bgpl\b)"),
    ("OrLater", r"or \(?(at your option\)? )?any later version"),
    ("Apache2", r"apache license,? ?(version|v)? ?2(\.0)?"),
    ("Apache11", r"apache (software )?license,? ?(version|v)? ?1\.1"),
    ("ApacheCompliance", r"you may not use this file except in compliance with the license"),
    ("ApacheCopy", r"you may obtain a copy of the license at"),
    ("ApacheNoWarranty", r"distributed on an as is basis without warranties or conditions of any kind"),
    ("ApacheSeeLicense", r"see the license for the specific language governing permissions"),
    ("CCBYNCSA", r"(cc[ -]by[ -]nc[ -]sa|attribution[ -]noncommercial[ -]sharealike) ?([0-9.]+)?"),
    ("CCBYNCND", r"(cc[ -]by[ -]nc[ -]nd|attribution[ -]noncommercial[ -]noderiv[a-z]*) ?([0-9.]+)?"),
    ("CCBYNC", r"(cc[ -]by[ -]nc|attribution[ -]noncommercial) ?([0-9.]+)?"),
    ("CCBYSA", r"(cc[ -]by[ -]sa|attribution[ -]sharealike) ?([0-9.]+)?"),
    ("CCBYND", r"(cc[ -]by[ -]nd|attribution[ -]noderiv[a-z]*) ?([0-9.]+)?"),
    ("CC0", r"\bcc0\b|creative commons zero|public domain dedication"),
    ("CCBY", r"(cc[ -]by|creative commons attribution) ?([0-9.]+)?"),
    ("MITname", r"\b(mit|expat) license"),
    ("MITgrant", r"permission is hereby granted,? free of charge,? to any person obtaining a copy of this software"),
    ("MITnotice", r"above copyright notice and this permission notice shall be included in all copies"),
    ("MITasis", r"the software is provided as is,? without warranty of any kind"),
    ("MITliability", r"in no event shall the authors or copyright holders be liable"),
    ("ISCgrant", r"permission to use,? copy,? modify,? and/?(or)? distribute this software for any purpose"),
    ("ISCasis", r"the software is provided as is and the author disclaims all warranties"),
    ("BSDgrant", r"redistribution and use in source and binary forms,? with or without modification,? are permitted"),
    ("BSDsource", r"redistributions of source code must retain the above copyright notice"),
    ("BSDbinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BSDendorse", r"neither the name .* may be used to endorse or promote products"),
    ("BSDadvert", r"all advertising materials mentioning features or use of this software must display"),
    ("BSDasis", r"this software is provided by the .* as is"),
    ("BSDliability", r"in no event shall the .* be liable for any direct,? indirect"),
    ("BSDname3", r"\b(new|modified|revised|3[ -]clause|three[ -]clause) bsd license|bsd 3[ -]clause"),
    ("BSDname2", r"\b(simplified|freebsd|2[ -]clause|two[ -]clause) bsd license|bsd 2[ -]clause"),
    ("MPL2", r"mozilla public license,? ?(version|v\.?)? ?2(\.0)?"),
    ("EPL2", r"eclipse public license,? ?(version|v)? ?2(\.0)?"),
    ("EPL1", r"eclipse public license,? ?(version|v)? ?1(\.0)?"),
    ("BSL1", r"boost software license"),
    ("ZlibAsIs", r"this software is provided as is,? without any express or implied warranty"),
    ("ZlibGrant", r"permission is granted to anyone to use this software for any purpose"),
    ("Unlicense", r"this is free and unencumbered software released into the public domain"),
    ("PublicDomain", r"(placed in|released (in)?to|in) the public domain"),
    ("Proprietary", r"proprietary and confidential|unauthori[sz]ed copying"),
    ("AllRights", r"all rights reserved"),
    ("SeeFile", r"(see|in) (the )?(accompanying )?(license|copying)( file|\.txt|\.md)"),
    ("Copyright", r"copyright (\(c\)|©|[0-9]{4}|by )"),
]

# Licence and the sequence of sentence identifiers that means it. Rules are tried in this order, and what a
# rule has read is no longer there for later ones; copyright lines carry no licence.
RULES = [
    ("AGPL-3.0-or-later", ["AGPL3", "OrLater"]),
    ("LGPL-3.0-or-later", ["LGPL3", "OrLater"]),
    ("LGPL-2.1-or-later", ["LGPL21", "OrLater"]),
    ("GPL-3.0-or-later", ["GPL3plus", "GplNoWarranty", "GplCopy"]),
    ("GPL-2.0-or-later", ["GPL2plus", "GplNoWarranty", "GplCopy"]),
    ("AGPL-3.0-or-later", ["AGPL3plus"]),
    ("LGPL-3.0-or-later", ["LGPL3plus"]),
    ("LGPL-2.1-or-later", ["LGPL21plus"]),
    ("GPL-3.0-or-later", ["GPL3plus"]),
    ("GPL-2.0-or-later", ["GPL2plus"]),
    ("GPL-3.0-or-later", ["GPL3", "OrLater", "GplNoWarranty", "GplCopy"]),
    ("GPL-3.0-or-later", ["GPL3", "OrLater"]),
    ("GPL-2.0-or-later", ["GPL2", "OrLater", "GplNoWarranty", "GplCopy"]),
    ("GPL-2.0-or-later", ["GPL2", "OrLater"]),
    ("Apache-2.0", ["Apache2", "ApacheCompliance", "ApacheCopy", "ApacheNoWarranty", "ApacheSeeLicense"]),
    ("Apache-2.0", ["Apache2", "ApacheCompliance", "ApacheCopy"]),
    ("BSD-4-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDadvert", "BSDendorse", "BSDasis", "BSDliability"]),
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse", "BSDasis", "BSDliability"]),
    ("BSD-3-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary", "BSDasis", "BSDliability"]),
    ("BSD-2-Clause", ["BSDgrant", "BSDsource", "BSDbinary"]),
    ("MIT", ["MITname", "MITgrant", "MITnotice", "MITasis", "MITliability"]),
    ("MIT", ["MITgrant", "MITnotice", "MITasis", "MITliability"]),
    ("MIT", ["MITgrant", "MITnotice", "MITasis"]),
    ("MIT", ["MITgrant", "MITnotice"]),
    ("MIT-0", ["MITgrant", "MITasis"]),
    ("ISC", ["ISCgrant", "ISCasis"]),
    ("Zlib", ["ZlibAsIs", "ZlibGrant"]),
    ("AGPL-3.0", ["AGPL3"]),
    ("LGPL-3.0", ["LGPL3"]),
    ("LGPL-2.1", ["LGPL21"]),
    ("GPL-3.0", ["GPL3"]),
    ("GPL-2.0", ["GPL2"]),
    ("GPL", ["GPLany"]),
    ("Apache-2.0", ["Apache2"]),
    ("Apache-1.1", ["Apache11"]),
    ("CC-BY-NC-SA", ["CCBYNCSA"]),
    ("CC-BY-NC-ND", ["CCBYNCND"]),
    ("CC-BY-NC", ["CCBYNC"]),
    ("CC-BY-SA", ["CCBYSA"]),
    ("CC-BY-ND", ["CCBYND"]),
    ("CC0-1.0", ["CC0"]),
    ("CC-BY", ["CCBY"]),
    ("MIT", ["MITname"]),
    ("ISC", ["ISCgrant"]),
    ("BSD-3-Clause", ["BSDname3"]),
    ("BSD-2-Clause", ["BSDname2"]),
    ("MPL-2.0", ["MPL2"]),
    ("EPL-2.0", ["EPL2"]),
    ("EPL-1.0", ["EPL1"]),
    ("BSL-1.0", ["BSL1"]),
    ("Unlicense", ["Unlicense"]),
    ("Public-Domain", ["PublicDomain"]),
    ("Proprietary", ["Proprietary"]),
    ("See-File", ["SeeFile"]),
    ("All-Rights-Reserved", ["AllRights"]),
]
SILENT = ("Copyright",)


# What the standard wordings need beside the lists above, which the SQL twin reads as they are.
_LATER = r"either version {} of the license,? or \(?at your option\)? any later version"
OWN_SENTENCES = [
    ("GplDetails", r"see the gnu (lesser |affero |library )?general public license for more details"),
    ("Later3", _LATER.format("3")),
    ("Later21", _LATER.format(r"2\.1")),
    ("Later2", _LATER.format("2")),
    ("MITnotice", r"above copyright notice and this permission notice \(including the next paragraph\) shall be included in all copies"),
    ("0BSDgrant", r"permission to use, copy, modify, and (or )?distribute this software for any purpose with or without fee is hereby granted\.?$"),
    ("ISCgrant", r"permission to use,? copy,? modify,? and (or )?distribute this software for any purpose"),
    ("ISCasis", r"the software is provided as is and .{1,60} disclaims all warranties"),
    ("ApacheNoWarranty", r"distributed on an as is basis, without warranties or conditions of any kind"),
    ("CCBY", r"\battribution [0-9.]+ (international|unported|generic)"),
]
# a whole known sentence of the list above goes before these: AGPL3plus before Later3
_FIRST = [x for x in SENTENCES if x[0].endswith("plus")]
FAMILIES = [("LGPLany", r"gnu lesser general public license"), ("AGPLany", r"gnu affero general public license")]
ALL_SENTENCES = [*_FIRST, *OWN_SENTENCES, *[x for x in SENTENCES if x not in _FIRST and x[0] != "SPDX"], *FAMILIES]

# What stands in the sentences above that need not hold a critical word; a test proves that nothing is missing.
PHRASES = [
    "all advertising materials mentioning features or use of this software must display", "attribution", "bsd 2 clause", "bsd 3 clause",
    "copying", "international", "proprietary and confidential", "you should have received a copy of the gnu",
]

#: Licence names of SPDX tags, in lower case, and the names the rules give.
SPDX_NAMES = {name.lower(): name for name, _ in RULES if name not in ("See-File", "All-Rights-Reserved", "Proprietary", "Public-Domain", "GPL")} | {
    f"{short.lower()}{end}": short + mark
    for short in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
    for end, mark in (("-only", ""), ("+", "-or-later"))
} | {
    f"{short.lower()}-{version}": short
    for short in ("CC-BY", "CC-BY-SA", "CC-BY-ND", "CC-BY-NC", "CC-BY-NC-SA", "CC-BY-NC-ND")
    for version in ("1.0", "2.0", "2.5", "3.0", "4.0")
} | {"0bsd": "0BSD"}

OWN_RULES = [
    ("GPL-3.0-or-later", ["GPLany", "Later3"]),
    ("GPL-2.0-or-later", ["GPLany", "Later2"]),
    ("LGPL-3.0-or-later", ["LGPLany", "Later3"]),
    ("LGPL-2.1-or-later", ["LGPLany", "Later21"]),
    ("AGPL-3.0-or-later", ["AGPLany", "Later3"]),
]
ALL_RULES = [
    *OWN_RULES,
    *RULES,
    ("0BSD", ["0BSDgrant"]),
    ("LGPL", ["LGPLany"]),
    ("AGPL", ["AGPLany"]),
    *[(name, [f"SPDX:{name}"]) for name in sorted(set(SPDX_NAMES.values()))],
]
#: Sentences that stand between those of a rule and mean nothing by themselves; rules step over them.
ALL_SILENT = (*SILENT, "GplDetails")
#: Unknown sentences in a row that a rule steps over: the standard texts have no more between their known ones.
UNKNOWN_STEPS = 2
SPDX_TAG = r"(?i)(spdx-license-identifier:[^\x0A\x0D]*)"


def normalised(sentence: Column) -> Column:
    """Lower case, American spelling; comment marks, quotes, hyphens and runs of blanks are one blank, none before a comma."""
    s = F.lower(sentence)
    s = F.regexp_replace(s, r"""["'`*#/_:<>|\u201c\u201d\u2018\u2019\u00ab\u00bb\u2010\u2011\u2013\u2014-]+""", " ")
    s = F.regexp_replace(s, "licence", "license")
    s = F.regexp_replace(s, r"[\x20\x09-\x0D\u00a0]+", " ")
    return F.trim(F.regexp_replace(s, " ,", ","))


def prefilter(phrases: list[str] = PHRASES) -> str:
    """A pattern on lower-case text that finds something in every known and every critical sentence, wrapped and marked or not."""
    return re.sub(r"\[ -\]| ", "[^a-z0-9]+", "|".join([CRITICAL.removeprefix("(?i)"), *phrases]))


#: What parts the names of an SPDX tag, and the mark that holds a licence and its exception together meanwhile.
SPDX_PARTS, SPDX_WITH = r"[^A-Za-z0-9.+~-]+|-->|--$", r"(?i)[\x20\x09]+with[\x20\x09]+([a-z0-9.-]+)"


def spdx_ids(tag: Column) -> Column:
    """The identifiers of the licences that an SPDX tag names, each with its exception; ``SPDX`` if none of them is known."""
    bare = F.regexp_replace(F.regexp_replace(tag, "(?i)^.*?identifier:", ""), SPDX_WITH, "~$1")
    table = F.create_map(*[F.lit(x) for pair in SPDX_NAMES.items() for x in pair])

    def named(word: Column) -> Column:
        licence = table[F.lower(F.regexp_replace(F.substring_index(word, "~", 1), r"[.-]+$", ""))]
        besides = F.when(F.contains(word, F.lit("~")), F.concat(F.lit(" WITH "), F.regexp_replace(F.substring_index(word, "~", -1), r"[.-]+$", "")))
        return F.concat(F.lit("SPDX:"), licence, F.coalesce(besides, F.lit("")))

    names = F.array_compact(F.transform(F.split(bare, SPDX_PARTS), named))
    return F.when(F.size(names) > 0, names).otherwise(F.array(F.lit("SPDX")))


def sentence_ids(text: Column, sentences: list[tuple[str, str]] = ALL_SENTENCES, phrases: list[str] = PHRASES) -> Column:
    """The identifiers of the licence sentences of a text, in order; ``?`` for one that sounds like a licence but is unknown.

    A line with an SPDX tag is a sentence from the tag on, and gives an identifier for each licence it names. The stop in
    "v. 2" ends none. ``phrases`` has one of every sentence that can do without a critical word.
    """
    likely = prefilter(phrases)

    def one(part: Column) -> Column:
        sentence = part["clean"]
        known = reduce(lambda when, rule: when.when(sentence.rlike(rule[1]), rule[0]), sentences[1:], F.when(sentence.rlike(sentences[0][1]), sentences[0][0]))
        known = known.when(part["raw"].rlike(CRITICAL), "?")
        return F.when(part["raw"].rlike(SPDX_TAG), spdx_ids(part["raw"])).otherwise(F.array_compact(F.array(known)))

    lines = F.regexp_replace(F.regexp_replace(text, r"(?i)\b(v)\.[\x20\x09]+(?=[0-9])", "$1 "), SPDX_TAG, "\n\n$1\n\n")
    parts = F.filter(F.split(lines, SENTENCE_END), lambda s: F.lower(s).rlike(likely))
    both = F.transform(parts, lambda s: F.struct(s.alias("raw"), normalised(s).alias("clean")))
    ids = F.flatten(F.transform(both, one))
    return F.when(F.lower(text).rlike(likely), ids).otherwise(F.array().cast("array<string>"))


def rule_pattern(ids: list[str]) -> str:
    """The sequence of a rule as a pattern on ``,A,,B,``, with a few unknown sentences between its own."""
    return f"(,[?],){{0,{UNKNOWN_STEPS}}}".join(f",{i}," for i in ids)


def read_rules(ids: Column, rules: list[tuple[str, list[str]]] = ALL_RULES) -> Column:
    """(what is left of the sequence, licences found in rule order): each rule in turn takes its sequence out.

    The sequence is written as ``,A,,B,`` so that an identifier is found whole; a mark stays where a sequence was taken
    out, so that its neighbours do not become adjacent. Up to ``UNKNOWN_STEPS`` unknown sentences in a row may stand
    between two of a rule. SPDX names with an exception need no rule: each is a licence of its own.
    """
    spoken = F.filter(ids, lambda x: ~x.isin(*ALL_SILENT))
    left = F.concat_ws("", F.transform(spoken, lambda x: F.concat(F.lit(","), x, F.lit(","))))
    # the rules are a literal array, so that their number does not grow the expression
    table = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(f",{of[0]},").alias("first"), F.lit(f",{of[-1]},").alias("last"), F.lit(rule_pattern(of)).alias("pattern"))
        for name, of in rules
    ])
    exceptions = F.transform(F.filter(ids, lambda x: F.contains(x, F.lit(" WITH "))), lambda x: F.substring(x, 6, 1 << 20))
    start = F.struct(left.alias("left"), exceptions.alias("found"))

    def step(acc: Column, rule: Column) -> Column:
        there = F.contains(acc["left"], rule["first"]) & F.contains(acc["left"], rule["last"])
        # plain searches first: a pattern is tried where the ends of its sequence stand
        return F.when(
            F.when(there, F.regexp_like(acc["left"], rule["pattern"])).otherwise(F.lit(False)),
            F.struct(F.regexp_replace(acc["left"], rule["pattern"], F.lit("|")).alias("left"), F.array_append(acc["found"], rule["name"]).alias("found")),
        ).otherwise(acc)

    return F.aggregate(table, start, step)


def licence_scan(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    sentences: list[tuple[str, str]] = ALL_SENTENCES, rules: list[tuple[str, list[str]]] = ALL_RULES, phrases: list[str] = PHRASES,
) -> DataFrame:
    """One row per input row: id, ``sentence_ids`` (comma-joined, in order), ``licences`` (distinct, by name), counts, ``verdict``.

    All work is inside the row: no row moves, and a hot source or a group of copies costs what its rows cost. ``verdict`` is
    ``none`` without licence sentences, ``unknown`` where no rule holds, ``single`` or ``several`` otherwise. Null text
    counts as empty; empty texts have no sentences. Repeated rows give repeated rows; other columns are ignored.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    known = docs.select(column(id_col).alias("doc_id"), sentence_ids(text, sentences, phrases).alias("ids"))
    ruled = known.select("doc_id", "ids", F.when(F.size("ids") > 0, read_rules(F.col("ids"), rules)).alias("read"))
    names = F.coalesce(F.array_sort(F.array_distinct(F.col("read.found"))), F.array().cast("array<string>"))
    return ruled.select(
        "doc_id",
        F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(names, ",").alias("licences"),
        F.size("ids").cast("long").alias("n_sentences"),
        F.size(F.filter("ids", lambda x: x == "?")).cast("long").alias("n_unknown"),
        F.when(F.size("ids") == 0, "none").when(F.size(names) == 0, "unknown").when(F.size(names) == 1, "single").otherwise("several").alias("verdict"),
    )
