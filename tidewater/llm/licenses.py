"""License scan: ordered signature rules behind keyword gates, with containment suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, cut

NON_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Fixed phrases and the labels they carry.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_V = "(?:version |v)?"
#: Licenses: label; keyword that its rules are gated by; name; identifier. All over
#: lower-cased words with one space between, so that "2.0" reads "2 0".
FAMILIES = [
    ("mit", "mit", "(?:the )?(?:expat |x11 )?mit license", "mit"),
    ("mit-0", "mit", "mit no attribution(?: license)?", "mit 0"),
    ("apache-2.0", "apache", f"apache (?:software )?license {_V}2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", f"apache (?:software )?license {_V}1 1", "apache 1 1"),
    ("gpl-2.0", "gpl", "gpl(?: ?v ?| version | )?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "gpl", "gpl(?: ?v ?| version | )?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-2.0", "general public", f"(?:gnu )?general public license {_V}2(?: 0)?", "gpl 2"),
    ("gpl-3.0", "general public", f"(?:gnu )?general public license {_V}3(?: 0)?", "gpl 3"),
    ("lgpl-2.1", "lesser general", f"(?:gnu )?lesser general public license {_V}2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "lesser general", f"(?:gnu )?lesser general public license {_V}3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "lgpl", "lgpl(?: ?v ?| version | )?2 1", "lgpl 2"),
    ("lgpl-3.0", "lgpl", "lgpl(?: ?v ?| version | )?3(?: 0)?", "lgpl 3"),
    ("agpl-3.0", "affero", f"(?:gnu )?affero general public license(?: {_V}3(?: 0)?)?", "agpl 3 0(?: only| or later)?"),
    ("agpl-3.0", "agpl", "agpl(?: ?v ?| version | )?3(?: 0)?", "agpl 3"),
    ("gfdl", "free documentation", "(?:gnu )?free documentation license", "gfdl 1 [123]"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|freebsd)(?: license)?", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause)(?: license)?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause)(?: license)?", "bsd 4 clause"),
    ("0bsd", "bsd", "(?:zero clause bsd|0bsd)(?: license)?", "0bsd"),
    ("bsd", "bsd", "bsd (?:style )?license", "bsd"),
    ("mpl-1.1", "mozilla", f"mozilla public license {_V}1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", f"mozilla public license {_V}2(?: 0)?", "mpl 2 0"),
    ("mpl-2.0", "mpl", "mpl(?: ?v ?| version | )?2(?: 0)?", "mpl 2"),
    ("epl-1.0", "eclipse", f"eclipse public license {_V}1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse", f"eclipse public license {_V}2(?: 0)?", "epl 2 0"),
    ("cddl-1.0", "common development", "common development and distribution license", "cddl 1 [01]"),
    ("cpl-1.0", "common public", "common public license", "cpl 1 0"),
    ("eupl-1.2", "european union", "european union public licen[cs]e", "eupl 1 [12]"),
    ("isc", "isc", "isc license", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)? license", "zlib"),
    ("bsl-1.0", "boost", "boost software license", "bsl 1 0"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("artistic-2.0", "artistic", "artistic license(?: 2(?: 0)?)?", "artistic 2 0"),
    ("psf-2.0", "python software", "python software foundation license", "psf 2 0"),
    ("ofl-1.1", "open font", "(?:sil )?open font license", "ofl 1 1"),
    ("ms-pl", "microsoft public", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal license", "ms rl"),
    ("odbl-1.0", "open database", "open database license", "odbl 1 0"),
    ("odc-by-1.0", "open data commons", "open data commons attribution license", "odc by 1 0"),
    ("pddl-1.0", "public domain dedication", "public domain dedication and license", "pddl 1 0"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("bigscience-rail", "rail", "(?:bigscience |open )?rail(?: m)? license", "openrail"),
    ("sspl-1.0", "server side", "server side public license", "sspl 1 0"),
    ("busl-1.1", "business source", "business source license", "busl 1 1"),
    ("elastic-2.0", "elastic", "elastic license(?: 2(?: 0)?)?", "elastic 2 0"),
    ("ogl-uk-3.0", "open government", "open government licen[cs]e", "ogl uk 3 0"),
]
#: Attribution licenses: suffix of the label, short and long form of the conditions.
CC_CONDITIONS = [
    ("", "", ""),
    ("-nc", " nc", " non ?commercial"),
    ("-sa", " sa", " share ?alike"),
    ("-nd", " nd", " no ?deriv(?:ative)?s(?: works)?"),
    ("-nc-sa", " nc sa", " non ?commercial share ?alike"),
    ("-nc-nd", " nc nd", " non ?commercial no ?deriv(?:ative)?s(?: works)?"),
]
CC_VERSIONS = ["2 0", "2 5", "3 0", "4 0"]
#: Forms: priority, confidence, pattern around the name.
FORMS = [
    (40, 0.95, "licensed under (?:the )?(?:terms of )?(?:the )?{name}"),
    (40, 0.95, "(?:released|distributed|published|available|provided|offered) under (?:the )?(?:terms of )?(?:the )?{name}"),
    (30, 0.80, "{name} (?:agreement|terms|file|text|conditions)"),
    (20, 0.60, "{name}"),
]
#: Full texts and notices: label, priority, confidence, keyword, pattern.
NOTICES = [
    ("mit", 60, 1.0, "permission is hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 60, 0.9, "permission to use", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", 60, 0.9, "redistribution and", "redistribution and use in source and binary forms"),
    ("bsd-3-clause", 60, 0.9, "nor the names of its contributors", "neither the name of .*? nor the names of its contributors"),
    ("gpl", 60, 0.9, "free software", "this program is free software you can redistribute it and or modify it"),
    ("gpl", 60, 0.9, "verbatim copies", "everyone is permitted to copy and distribute verbatim copies"),
    ("zlib", 60, 0.9, "as is without any", "provided as is without any express or implied warranty"),
    ("unlicense", 60, 1.0, "unencumbered", "free and unencumbered software released into the public domain"),
    ("public-domain", 30, 0.8, "public domain", "(?:dedicated to|released into|placed in|in) the public domain"),
    ("proprietary", 30, 0.8, "all rights reserved", "all rights reserved"),
    ("proprietary", 30, 0.8, "confidential", "proprietary and confidential"),
    ("copyright-notice", 10, 0.4, "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}"),
]


def rules() -> list[tuple[str, int, float, str, str]]:
    """(label, priority, confidence, keyword, pattern) in order; a few hundred."""
    families = list(FAMILIES)
    for suffix, short, long in CC_CONDITIONS:
        for v in CC_VERSIONS:
            name = f"(?:cc by{short}|creative commons attribution{long})(?: {v})(?: international| unported| generic)?"
            families.append((f"cc-by{suffix}-{v.replace(' ', '.')}", v, name, f"cc by{short} {v}"))
    out = list(NOTICES)
    for label, keyword, name, spdx in families:
        out.append((label, 50, 1.0, "spdx", f"spdx license identifier {spdx}"))
        out += [(label, p, c, keyword, form.format(name=name)) for p, c, form in FORMS]
    return [(label, p, c, k, f"(?<= )(?:{x})(?= )") for label, p, c, k, x in out]


def gates() -> list[str]:
    """Word beginnings one of which every text that a rule can match holds."""
    return [" licen", " copyright", " spdx", " unlicense", " permi", " redistribut", " public ", " gpl", " lgpl",
            " agpl", " mpl", " bsd", " 0bsd", " cc", " creative ", " wtfpl", " reserved ", " confidential ", " freebsd",
            " neither ", " verbatim ", " software ", " warranty ", " mit ", " gnu "]


def _normal(text: Column) -> Column:
    """Words between two spaces each, as one string: '  a  b  '."""
    padded = F.concat(F.lit("  "), ascii_lower(F.coalesce(text, F.lit(""))), F.lit("  "))
    return F.regexp_replace(padded, NON_WORD, "  ")


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _framed(phrase: str) -> str:
    return " " + phrase.replace(" ", "  ") + " "


def _base_columns(s: Column) -> list[Column]:
    """For each base phrase: places, first and last word."""
    out = []
    for k, phrase in enumerate(BASE):
        p = F.lit(_framed(phrase))
        back = F.lit(_framed(phrase)[::-1])
        n = (F.length(s) - F.length(F.replace(s, p, F.lit("")))) / len(_framed(phrase))
        here = F.contains(s, p)
        before = F.substring(s, F.lit(1), F.position(p, s))
        after = F.substring(F.reverse(s), F.lit(1), F.position(back, F.reverse(s)))
        words = len(phrase.split())
        out += [
            F.when(here, n).otherwise(0).cast("long").alias(f"n{k}"),
            F.when(here, _spaces(before) / 2 - 1).cast("long").alias(f"first{k}"),
            F.when(here, F.col("n_words") - (_spaces(after) / 2 - 1) - words).cast("long").alias(f"last{k}"),
        ]
    return out


def _marked(docs: DataFrame) -> DataFrame:
    """Base columns, and for each rule that matches the lengths of matches and of the gaps before them."""
    table = rules()
    literal = ",".join(
        f"named_struct('rule', {i}, 'key', '{k}', 'pattern', r'{x}')" for i, (_, _, _, k, x) in enumerate(table)
    )
    gate = F.lit(False)
    for g in gates():
        gate = gate | F.contains(F.col("s"), F.lit(g.replace(" ", "  ") if g.strip() == g else g))
    single = F.replace(F.col("s"), F.lit("  "), F.lit(" "))
    found = F.get(
        F.transform(
            F.array(single),
            lambda t: F.filter(
                F.transform(
                    F.filter(F.expr(f"array({literal})"), lambda r: F.contains(t, r["key"])),
                    lambda r: F.struct(
                        r["rule"].alias("rule"),
                        F.transform(F.split(t, r["pattern"]), F.length).alias("gaps"),
                        F.transform(F.regexp_extract_all(t, r["pattern"], F.lit(0)), F.length).alias("lengths"),
                    ),
                ),
                lambda h: F.size(h["lengths"]) > 0,
            ),
        ),
        F.lit(0),
    )
    return (
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", _normal(F.col("text")).alias("s"))
        .select("row", "doc_id", "s", (_spaces(F.col("s")) / 2 - 1).cast("long").alias("n_words"), gate.alias("gate"))
        .select(
            "row",
            "doc_id",
            "n_words",
            *_base_columns(F.col("s")),
            F.when(F.col("gate"), found).alias("found"),
        )
    )


def _detections(marked: DataFrame) -> DataFrame:
    """(row, doc_id, rule, label, start, end, ...) kept after suppression; offsets in the normalised text."""
    table = rules()
    info = F.expr(
        "array(" + ",".join(f"named_struct('label','{a}','priority',{p},'confidence',{c}D)" for a, p, c, _, _ in table) + ")"
    )
    parts = (
        marked.where(F.size("found") > 0)
        .select("row", "doc_id", F.explode("found").alias("f"))
        .select("row", "doc_id", "f.rule", F.posexplode(F.arrays_zip("f.gaps", "f.lengths")).alias("nth", "z"))
        .where(F.col("z.lengths").isNotNull())
        .select("row", "doc_id", "rule", "nth", F.col("z.gaps").alias("gap"), F.col("z.lengths").alias("length"))
    )
    run = W.partitionBy("row", "rule").orderBy("nth").rowsBetween(W.unboundedPreceding, 0)
    placed = parts.select(
        "row",
        "doc_id",
        "rule",
        "length",
        (F.sum(F.col("gap") + F.col("length")).over(run) - F.col("length")).alias("start"),
        F.get(info, F.col("rule")).alias("i"),
    ).select("row", "doc_id", "rule", "start", (F.col("start") + F.col("length")).alias("end"), "i.*")
    # A detection goes if one that came before it in this order, with at least its priority, reaches as far.
    order = W.partitionBy("row").orderBy("start", F.desc("end"), F.desc("priority"), "rule")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    levels = sorted({p for _, p, _, _, _ in table})
    reach = F.coalesce(
        *[F.when(F.col("priority") == p, F.max(F.when(F.col("priority") >= p, F.col("end"))).over(earlier)) for p in levels]
    )
    return placed.withColumn("reach", reach).where(F.col("reach").isNull() | (F.col("reach") < F.col("end"))).drop("reach")


def detect(docs: DataFrame) -> DataFrame:
    """Kept detections of every document: doc_id, rule, start, end, label, priority, confidence."""
    return _detections(cut(_marked(docs.select("doc_id", "text")))).drop("row")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every document.

    Each rule runs only on texts that pass the common gate and hold its keyword.
    A detection inside another one of equal or higher priority is suppressed. The
    score is the greatest confidence among those kept, 0 without any; a base
    phrase alone counts 0.6. Null texts have no words; every row is scanned by
    itself, whether its doc_id is null or repeats or not; empty tables give empty
    results; other columns are ignored.
    """
    marked = cut(_marked(docs.select("doc_id", "text")))
    best = (
        _detections(marked)
        .groupBy("row")
        .agg(F.collect_set("label").alias("found_labels"), F.max("confidence").alias("confidence"))
    )
    k = range(len(BASE))
    base = F.array_compact(F.array(*[F.when(F.col(f"n{i}") > 0, F.lit(v)) for i, v in enumerate(BASE.values())]))
    return (
        marked.drop("found")
        .join(best, "row", "left")
        .withColumn("base", F.array_sort(F.array_distinct(base)))
        .select(
            "doc_id",
            "n_words",
            sum((F.col(f"n{i}") for i in k), F.lit(0)).cast("long").alias("n_base"),
            F.least(*[F.col(f"first{i}") for i in k]).alias("first_word"),
            F.greatest(*[F.col(f"last{i}") for i in k]).alias("last_word"),
            F.array_join("base", ",").alias("base_labels"),
            F.array_join(
                F.array_sort(F.array_union("base", F.coalesce("found_labels", F.array().cast("array<string>")))), ","
            ).alias("labels"),
            F.greatest(F.coalesce("confidence", F.lit(0.0)), F.when(F.size("base") > 0, 0.6).otherwise(0.0)).alias("score"),
        )
    )
