"""License scan with ordered signature rules, as DataFrame operations.

A rule is a regular expression over the text with A-Z lowered, gated by a keyword that any
match must contain, and has a priority and a relevance. Scanning goes in steps that each
cut the work for the next: a cheap pattern over the whole text finds the rows that hold
any root keyword; on those rows, rules whose keyword occurs are kept; only these are run.
All matches become intervals of characters. A detection is suppressed if another one of
the same row contains its interval and is longer, or as long and earlier in the rules'
order; one sweep over the sorted intervals finds them. What is left gives the labels.

The rules are families (name, versions) crossed with the phrasings by which licences are
declared, from the most exact to the loosest, then sentences of licence texts, SPDX
identifiers and addresses of licence texts, some hundreds in all.

Base phrases are found on word positions instead: words are maximal runs of ASCII letters
and digits and of characters beyond ASCII; a phrase is found where its words stand one
after the other, whatever separates them.

Defined results: null counts as the empty text: no words, no labels, score 0, first_word
and last_word null. Repeated rows give equal results; extra columns are never read; very
long texts are scanned whole. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Words of the base scan, on text with A-Z lowered, and the characters between them.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Licence families as (label, name pattern, keyword, versions).
FAMILIES = [
    ("agpl", r"(?:gnu )?(?:affero general public licen[sc]e|agpl)", "agpl|affero", ["1.0", "2.0", "3.0"]),
    ("lgpl", r"(?:gnu )?(?:lesser general public licen[sc]e|library general public licen[sc]e|lgpl)", "lgpl|lesser|library general", ["2.0", "2.1", "3.0"]),
    ("gpl", r"(?:gnu )?(?:general public licen[sc]e|gpl)", "gpl|general public", ["1.0", "2.0", "3.0"]),
    ("gfdl", r"(?:gnu )?(?:free documentation licen[sc]e|gfdl)", "gfdl|free documentation", ["1.1", "1.2", "1.3"]),
    ("apache", r"apache(?: software)? licen[sc]e", "apache", ["1.0", "1.1", "2.0"]),
    ("mpl", r"(?:mozilla public licen[sc]e|mpl)", "mozilla|mpl", ["1.0", "1.1", "2.0"]),
    ("epl", r"(?:eclipse public licen[sc]e|epl)", "eclipse|epl", ["1.0", "2.0"]),
    ("cddl", r"(?:common development and distribution licen[sc]e|cddl)", "common development|cddl", ["1.0", "1.1"]),
    ("eupl", r"(?:european union public licen[sc]e|eupl)", "european union|eupl", ["1.0", "1.1", "1.2"]),
    ("osl", r"(?:open software licen[sc]e|osl)", "open software|osl", ["1.0", "1.1", "2.0", "2.1", "3.0"]),
    ("afl", r"(?:academic free licen[sc]e|afl)", "academic free|afl", ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("artistic", r"artistic licen[sc]e", "artistic", ["1.0", "2.0"]),
    ("boost", r"boost software licen[sc]e", "boost", ["1.0"]),
    ("ms-pl", r"microsoft public licen[sc]e", "microsoft public", []),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", "microsoft reciprocal", []),
    ("odbl", r"(?:open database licen[sc]e|odbl)", "open database|odbl", ["1.0"]),
    ("pddl", r"(?:public domain dedication and licen[sc]e|pddl)", "public domain dedication|pddl", ["1.0"]),
    ("psf", r"(?:python software foundation licen[sc]e|psf licen[sc]e)", "python software|psf", ["2.0"]),
    ("zpl", r"zope public licen[sc]e", "zope", ["1.1", "2.0", "2.1"]),
    ("cecill", r"cecill(?:-[bc])?(?: free software licen[sc]e)?", "cecill", ["1.0", "2.0", "2.1"]),
    ("wtfpl", r"(?:do what the fuck you want to public licen[sc]e|wtfpl)", "wtfpl|do what the", ["2.0"]),
    ("unlicense", r"(?:the )?unlicense", "unlicense", []),
    ("isc", r"isc licen[sc]e", "isc", []),
    ("zlib", r"zlib(?: libpng)? licen[sc]e", "zlib", []),
    ("mit", r"(?:mit|expat|x11) licen[sc]e", "mit|expat|x11", []),
    ("bsd", r"(?:(?:[234]|two|three|four)[- ]clause )?bsd(?: (?:[234]|two|three|four)[- ]clause)? licen[sc]e", "bsd", []),
    ("cc0", r"(?:creative commons zero|cc0|cc zero)", "cc0|commons zero|cc zero", ["1.0"]),
    ("cc-by-nc-nd", r"(?:creative commons attribution[- ]non-?commercial[- ]no-?deriv(?:ative)?s|cc[- ]by[- ]nc[- ]nd)", "cc|creative commons", ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nc-sa", r"(?:creative commons attribution[- ]non-?commercial[- ]share-?alike|cc[- ]by[- ]nc[- ]sa)", "cc|creative commons", ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nc", r"(?:creative commons attribution[- ]non-?commercial|cc[- ]by[- ]nc)", "cc|creative commons", ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-nd", r"(?:creative commons attribution[- ]no-?deriv(?:ative)?s|cc[- ]by[- ]nd)", "cc|creative commons", ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by-sa", r"(?:creative commons attribution[- ]share-?alike|cc[- ]by[- ]sa)", "cc|creative commons", ["2.0", "2.5", "3.0", "4.0"]),
    ("cc-by", r"(?:creative commons attribution|cc[- ]by)", "cc|creative commons", ["2.0", "2.5", "3.0", "4.0"]),
]
# Declarations and texts that need no name: (label, pattern, keyword, relevance).
TEXTS = [
    ("mit", r"permission is hereby granted,? free of charge,? to any person obtaining a copy", "permission is hereby granted", 0.9),
    ("isc", r"permission to use, copy, modify,? and(?: or)? distribute this software", "permission to use", 0.85),
    ("bsd", r"redistribution and use in source and binary forms", "redistribution and use", 0.85),
    ("zlib", r"this software is provided 'as-is', without any express or implied warranty", "as-is", 0.8),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 0.95),
    ("public-domain", r"(?:released|placed|dedicated) (?:in)?to the public domain", "public domain", 0.6),
    ("proprietary", r"all rights reserved", "all rights reserved", 0.4),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", "proprietary", 0.6),
]
# SPDX identifiers as (label, identifiers as patterns); -only, -or-later and + may follow.
SPDX = [
    ("mit", "mit"), ("mit-0", "mit-0"), ("isc", "isc"), ("zlib", "zlib"), ("x11", "x11"), ("0bsd", "0bsd"), ("bsd-2-clause", "bsd-2-clause"), ("bsd-3-clause", "bsd-3-clause"), ("bsd-4-clause", "bsd-4-clause"),
    *[(f"apache-{v}", rf"apache-{v}") for v in ("1.0", "1.1", "2.0")], *[(f"agpl-{v}", rf"agpl-{v}") for v in ("1.0", "3.0")], *[(f"lgpl-{v}", rf"lgpl-{v}") for v in ("2.0", "2.1", "3.0")],
    *[(f"gpl-{v}", rf"gpl-{v}") for v in ("1.0", "2.0", "3.0")], *[(f"gfdl-{v}", rf"gfdl-{v}") for v in ("1.1", "1.2", "1.3")], *[(f"mpl-{v}", rf"mpl-{v}") for v in ("1.0", "1.1", "2.0")],
    *[(f"epl-{v}", rf"epl-{v}") for v in ("1.0", "2.0")], *[(f"cddl-{v}", rf"cddl-{v}") for v in ("1.0", "1.1")], *[(f"eupl-{v}", rf"eupl-{v}") for v in ("1.0", "1.1", "1.2")],
    *[(f"osl-{v}", rf"osl-{v}") for v in ("1.0", "1.1", "2.0", "2.1", "3.0")], *[(f"afl-{v}", rf"afl-{v}") for v in ("1.1", "1.2", "2.0", "2.1", "3.0")], *[(f"artistic-{v}", rf"artistic-{v}") for v in ("1.0", "2.0")],
    ("boost-1.0", "bsl-1.0"), ("ms-pl", "ms-pl"), ("ms-rl", "ms-rl"), ("odbl-1.0", "odbl-1.0"), ("pddl-1.0", "pddl-1.0"), ("psf-2.0", "psf-2.0"), ("psf-2.0", "python-2.0"), *[(f"zpl-{v}", rf"zpl-{v}") for v in ("1.1", "2.0", "2.1")],
    *[(f"cecill-{v}", rf"cecill-{v}") for v in ("1.0", "2.0", "2.1")], ("cecill", "cecill-b"), ("cecill", "cecill-c"), ("wtfpl", "wtfpl"), ("unlicense", "unlicense"), ("cc0-1.0", "cc0-1.0"),
    *[(f"{cc}-{v}", f"{cc}-{v}") for cc in ("cc-by", "cc-by-sa", "cc-by-nd", "cc-by-nc", "cc-by-nc-sa", "cc-by-nc-nd") for v in ("2.0", "2.5", "3.0", "4.0")],
]
# Addresses of licence texts, as (label, pattern with blanks for slashes).
ADDRESSES = [
    ("apache-2.0", r"apache\.org licenses license-2\.0"), ("apache-1.1", r"apache\.org licenses license-1\.1"), ("apache-2.0", r"opensource\.org licenses? apache-2\.0"),
    ("mit", r"opensource\.org licenses? mit(?:-license)?"), ("isc", r"opensource\.org licenses? isc(?:-license)?"), ("zlib", r"opensource\.org licenses? zlib"),
    ("bsd-2-clause", r"opensource\.org licenses? bsd-2-clause"), ("bsd-3-clause", r"opensource\.org licenses? bsd-3-clause"), ("0bsd", r"opensource\.org licenses? 0bsd"),
    ("mpl-2.0", r"mozilla\.org (?:en-us )?mpl 2\.0"), ("mpl-1.1", r"mozilla\.org (?:en-us )?mpl 1\.1"), ("mpl-2.0", r"opensource\.org licenses? mpl-2\.0"),
    ("epl-1.0", r"eclipse\.org legal epl-v10"), ("epl-2.0", r"eclipse\.org legal epl-(?:v20|2\.0)"), ("boost-1.0", r"boost\.org license_1_0"), ("unlicense", r"unlicense\.org"), ("wtfpl", r"wtfpl\.net"),
    ("gpl-2.0", r"gnu\.org licenses (?:old-licenses )?gpl-2\.0"), ("gpl-3.0", r"gnu\.org licenses gpl-3\.0"), ("gpl", r"gnu\.org (?:licenses|copyleft) gpl"), ("lgpl-2.1", r"gnu\.org licenses (?:old-licenses )?lgpl-2\.1"),
    ("lgpl-3.0", r"gnu\.org licenses lgpl-3\.0"), ("lgpl", r"gnu\.org (?:licenses|copyleft) (?:lgpl|lesser)"), ("agpl-3.0", r"gnu\.org licenses agpl-3\.0"), ("agpl", r"gnu\.org licenses agpl"), ("gfdl-1.3", r"gnu\.org licenses fdl-1\.3"),
    ("eupl-1.2", r"joinup\.ec\.europa\.eu [a-z -]{0,40}eupl"), ("artistic-2.0", r"opensource\.org licenses? artistic-2\.0"), ("cddl-1.0", r"opensource\.org licenses? cddl-1\.0"), ("cc0-1.0", r"creativecommons\.org publicdomain zero 1\.0"),
    ("public-domain", r"creativecommons\.org publicdomain mark 1\.0"), ("odbl-1.0", r"opendatacommons\.org licenses odbl"), ("pddl-1.0", r"opendatacommons\.org licenses pddl"),
    *[(f"cc-{kind}-{v}", rf"creativecommons\.org licenses {kind} {v[0]}\.{v[2]}") for kind in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd") for v in ("2.0", "2.5", "3.0", "4.0")],
]
#: What an identifier follows: the tag, then other identifiers of the same expression.
TAGGED = r"(?<=spdx-licen[sc]e-identifier:[ (]{0,3}" + r"(?:[a-z0-9.+-]{1,40}[ )]{1,3}(?:or|and|with)[ (]{1,3})?" * 8
BARE = r"(?:mit|apache|gpl|gfdl|mpl|epl|cddl|eupl|osl|afl|artistic|bsl|odbl|pddl|psf|zpl|cecill|cc0)-[0-9]|cecill-[bc]|bsd-[234]-clause|0bsd|ms-[pr]l|cc-by"
# How a name is declared, most exact first: (prefix pattern, suffix pattern, relevance).
PHRASINGS = [
    (r"spdx-licen[sc]e-identifier: ?", r"", 1.0),
    (r"(?:dual[- ])?licen[sc]ed under (?:the )?(?:terms of (?:the )?)?", r"", 0.95),
    (r"(?:released|distributed|published|available|provided) under (?:the )?(?:terms of (?:the )?)?", r"", 0.9),
    (r"", r"", 0.7),
]
#: Characters that the rules read as one blank, with blanks: marks of comments.
FOLDED = r"[\s*#>/]+"
#: Rows that hold none of these (with letters lowered) hold no detection at all. A blank stands
#: for FOLDED, as in the text that the rules read.
ROOTS = [
    "licen", "gpl", "gfdl", "cddl", "eupl", "odbl", "pddl", "cecill", "wtfpl", "cc0", "cc zero", "cc-by", "creative commons",
    "boost.org", "wtfpl.net", "gnu.org", "mozilla.org", "eclipse.org", "creativecommons.org", "europa.eu", "permission is", "permission to", "redistribution and", "as-is", "unencumbered", "public domain", "all rights reserved", "proprietary",
]
#: Short names that are parts of common words: words of their own, or before a number.
SHORT = r"(?<![\p{L}0-9])(?:(?:mpl|epl|osl|afl)(?!\p{L})|(?:apache|artistic|bsl|psf|zpl)-[0-9]|bsd-[234]-clause|0bsd|ms-[pr]l|mit-0)"


@dataclass(frozen=True)
class Rule:
    order: int
    label: str
    keyword: str
    pattern: str
    relevance: float


def rules() -> list[Rule]:
    """Families with each of their versions, then without one, by phrasing; then texts."""
    found: list[tuple[str, str, str, float]] = []
    for label, name in SPDX:
        whole = name.replace(".", r"\.") + r"(?:-only|-or-later|\+)?"
        found.append((label, rf"(?={whole}){TAGGED}){whole}", "spdx", 1.0))
    for prefix, suffix, relevance in PHRASINGS:
        for label, name, keyword, versions in FAMILIES:
            for version in versions:
                number = version.replace(".", r"\.")
                if version.endswith(".0"):
                    number = number[:-3] + r"(?:\.0)?(?!\.?[0-9])"
                spoken = rf"(?:,? ?\(?(?:version|ver\.?|v\.?)? ?|-){number}"
                found.append((f"{label}-{version}", prefix + name + spoken + suffix, keyword, relevance))
            found.append((label, prefix + name + suffix, keyword, relevance - 0.05))
    found += [(label, pattern, keyword, relevance) for label, pattern, keyword, relevance in TEXTS]
    found += [(label, pattern, r"\.(?:org|eu|net)", 0.9) for label, pattern in ADDRESSES]
    for label, name in SPDX:
        # without the tag: declared, or where the identifier is no common word
        whole = name.replace(".", r"\.") + r"(?:-only|-or-later|\+)?"
        found.append((label, PHRASINGS[1][0] + whole, "licen[sc]ed under", 0.95))
        if ("-" in name or name == "0bsd") and not name.startswith("python"):
            found.append((label, whole, BARE, 0.7))
    edged = ((label, rf"(?<![\p{{L}}0-9])(?:{pattern})(?![\p{{L}}0-9])", keyword, relevance) for label, pattern, keyword, relevance in found)
    return [Rule(i, label, keyword, pattern, relevance) for i, (label, pattern, keyword, relevance) in enumerate(edged)]


def lowered(text: Column) -> Column:
    """A-Z only; lengths stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


FOUND = "array<struct<order: int, label: string, relevance: double, start: bigint, stop: bigint>>"


def keywords(text_col: str) -> Column:
    """The keyword patterns that occur in a row's text."""
    gates = sorted({r.keyword for r in rules()})
    return F.array_compact(F.array(*[F.when(F.col(text_col).rlike(k), F.lit(k)) for k in gates]))


def detections(text_col: str, opened_col: str) -> Column:
    """All matches of the rules behind the opened keywords, in the order of the rules. The
    text must have A-Z lowered; a null text has none. (The columns are read twice, or the
    optimiser would move their expressions into the lambdas and run them once per rule.)"""
    opened = F.col(opened_col)
    table = F.array(*[F.struct(F.lit(r.order).alias("order"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern"), F.lit(r.relevance).alias("relevance")) for r in rules()])
    run = F.filter(table, lambda r: F.array_contains(opened, r["keyword"]))
    hits = F.transform(run, lambda r: F.struct(r.alias("rule"), F.regexp_extract_all(F.col(text_col), r["pattern"], F.lit(0)).alias("hits")))
    hits = F.filter(hits, lambda h: F.size(h["hits"]) > 0)
    # between the hits lie the pieces that split() gives, so running lengths give the places
    cut = F.transform(hits, lambda h: F.struct(h["rule"].alias("rule"), h["hits"].alias("hits"), F.split(F.col(text_col), h["rule"]["pattern"], F.size(h["hits"]) + 1).alias("pieces")))

    def places(h: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.char_length(F.get(h["pieces"], i))
            stop = start + F.char_length(F.get(h["hits"], i))
            one = F.struct(h["rule"]["order"].alias("order"), h["rule"]["label"].alias("label"), h["rule"]["relevance"].alias("relevance"), start.alias("start"), stop.alias("stop"))
            return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(FOUND).alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(h["hits"]) - 1), begin, step, lambda acc: acc["out"])

    return F.when(F.size(opened) > 0, F.flatten(F.transform(cut, places))).otherwise(F.array().cast(FOUND))


def unsuppressed(found: Column) -> Column:
    """The detections that no other contains which is longer, or as long and earlier in the
    rules' order: one sweep over them by start, longest first, then order. What contains a
    detection comes before it, so it stays if it ends beyond all before it."""
    order = F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["stop"]).alias("inverse"), d["order"].alias("order"), d["label"].alias("label"), d["relevance"].alias("relevance")))

    def step(acc: Column, d: Column) -> Column:
        one = F.struct(d["order"].alias("order"), d["label"].alias("label"), d["relevance"].alias("relevance"), d["start"].alias("start"), (-d["inverse"]).alias("stop"))
        longer = F.struct((-d["inverse"]).alias("reach"), F.concat(acc["out"], F.array(one)).alias("out"))
        return F.when(-d["inverse"] > acc["reach"], longer).otherwise(acc)

    begin = F.struct(F.lit(-1).cast("bigint").alias("reach"), F.array().cast(FOUND).alias("out"))
    return F.aggregate(F.array_sort(order), begin, step, lambda acc: acc["out"])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, detections (places in the text with blanks and comment marks folded)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")
    # a base phrase always passes the gate: it holds "license", or "cc" and "by" with a gap
    gate = F.col("folded").rlike(f"cc{GAP}+by")
    for root in ROOTS:
        first, *more = root.split(" ")
        held = F.col("folded").contains(first)
        gate = gate | (held & F.col("folded").rlike(root.replace(" ", FOLDED)) if more else held)
    gate = gate | F.col("folded").rlike(SHORT)
    rows = docs.select(F.col(id_col).alias("doc_id"), counted.alias("n_words"), text.alias("whole"), F.lower(text).alias("folded"))
    rows = rows.select("doc_id", "n_words", F.when(gate, lowered(F.col("whole"))).alias("low"))
    rows = rows.withColumn("words", F.coalesce(F.regexp_extract_all("low", F.lit(WORDS), F.lit(0)), F.array().cast("array<string>")))
    rows = rows.withColumn("flat", F.regexp_replace("low", FOLDED, " "))

    def starts(phrase: str) -> Column:
        each = " and ".join(f"get(words, i + {k}) = '{word}'" for k, word in enumerate(phrase.split(" ")))
        return F.expr(f"filter(if(size(words) > 0, sequence(0, size(words) - 1), cast(array() as array<int>)), i -> {each})")

    rows = rows.withColumns({f"at{i}": starts(phrase) for i, phrase in enumerate(BASE)})
    places = F.flatten(F.array(*[F.col(f"at{i}") for i in range(len(BASE))]))
    base = F.array_compact(F.array(*[F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, label in enumerate(BASE.values())]))
    rows = rows.select("doc_id", "n_words", places.alias("places"), F.array_sort(base).alias("base"), "flat", F.when(F.col("flat").isNotNull(), keywords("flat")).alias("opened"))
    rows = rows.withColumn("found", detections("flat", "opened"))
    rows = rows.withColumn("detections", unsuppressed(F.col("found")))
    labels = F.array_sort(F.array_union("base", F.transform("detections", lambda d: d["label"])))
    score = F.greatest(F.array_max(F.transform("detections", lambda d: d["relevance"])), F.when(F.size("base") > 0, 0.7), F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"), "detections",
    )
