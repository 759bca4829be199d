"""Licences: SPDX expressions parsed, simplified, normalised and classified; sources compared; texts printed and searched.

Python sees each distinct expression once; families and their facts stay in Spark.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.kernel import once

NOASSERTION = "NOASSERTION"
#: Groups of allowed licences, the best first.
GROUPS = ["open-font", "permissive", "attribution", "freeware"]
#: Statuses, the best first.
STATUS = ["allowed", "ruling", "excluded"]


@dataclass(frozen=True)
class Entry:
    """What is known of one licence id: its status, and for allowed ones group and terms."""

    status: str
    group: str = ""
    redistributable: bool = True
    attribution: bool = False


# An expression is an id (a string, with its exception: "A WITH b") or (operator, parts).
Expression = str | tuple


def split_at(tokens: list[str], operator: str) -> list[list[str]]:
    """Tokens between the operators that stand outside parentheses; unbalanced ones are an error."""
    out, depth = [[]], 0
    for t in tokens:
        depth += (t == "(") - (t == ")")
        if depth < 0:
            raise ValueError("unbalanced")
        if depth == 0 and t.upper() == operator:
            out.append([])
        else:
            out[-1].append(t)
    if depth:
        raise ValueError("unbalanced")
    return out


def parsed(text: str, leaf=None) -> Expression:
    """An expression of ids under WITH, AND and OR, binding in this order. `leaf` turns what stands for an id into an expression."""
    return _tree(re.findall(r"[()]|[^\s()]+", text), leaf or _id)


def _id(text: str) -> Expression:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.+-]*", text):
        raise ValueError(text)
    return text


def _tree(tokens: list[str], leaf) -> Expression:
    for operator in ("OR", "AND"):
        parts = split_at(tokens, operator)
        if len(parts) > 1:
            return (operator, tuple(_tree(p, leaf) for p in parts))
    sides = split_at(tokens, "WITH")
    if len(sides) == 2:
        one, other = (_tree(s, leaf) for s in sides)
        if not (isinstance(one, str) and isinstance(other, str)) or " WITH " in one + other:
            raise ValueError("WITH takes one id on each side")
        return f"{one} WITH {other}"
    if len(sides) > 2 or not tokens:
        raise ValueError("malformed")
    if tokens[0] == "(" and tokens[-1] == ")" and len(split_at(tokens[1:-1], "\0")) == 1:
        return _tree(tokens[1:-1], leaf)
    if "(" in tokens or ")" in tokens:
        raise ValueError("malformed")
    return leaf(" ".join(tokens))


def shown(e: Expression, inner: bool = False) -> str:
    if isinstance(e, str):
        return e
    text = f" {e[0]} ".join(shown(p, True) for p in e[1])
    return f"({text})" if inner else text


def simplified(e: Expression) -> Expression:
    """Nested equal operators flattened, parts distinct and sorted; NOASSERTION spoils AND and drops out of OR."""
    if isinstance(e, str):
        return NOASSERTION if e.split(" WITH ")[0] == NOASSERTION else e
    parts = {}
    for p in map(simplified, e[1]):
        for q in p[1] if not isinstance(p, str) and p[0] == e[0] else (p,):
            parts[shown(q, True)] = q
    if NOASSERTION in parts:
        if e[0] == "AND" or len(parts) == 1:
            return NOASSERTION
        del parts[NOASSERTION]
    ordered = tuple(parts[k] for k in sorted(parts))
    return ordered[0] if len(ordered) == 1 else (e[0], ordered)


def normalized_of(raw: str, source: str, table: dict[str, str]) -> str | None:
    """What a source wrote as a simplified expression, through a table of spellings; None where a part is unknown.

    The table is looked up by folded text, at 'source::text' first. An exception that stands alone is unknown.
    """

    def known(text: str) -> str | None:
        key = " ".join(text.casefold().split())
        return table.get(f"{source}::{key}", table.get(key))

    def leaf(text: str) -> Expression:
        value = known(text)
        if value is None:
            raise ValueError(text)
        return parsed(value)

    text = " ".join((raw or "").split())
    if not text:
        return None
    try:
        whole = known(text)
        found = simplified(parsed(whole) if whole else parsed(text, leaf))
    except ValueError:
        return None
    return None if any("exception" in i.split(" WITH ")[0].casefold() for i in leaves(found)) else shown(found)


def leaves(e: Expression) -> list[str]:
    return [e] if isinstance(e, str) else [i for p in e[1] for i in leaves(p)]


def _verdict(e: Expression, table: dict[str, Entry]) -> tuple[str, Entry]:
    """(the deciding expression, its entry) of a simplified expression."""
    if isinstance(e, str):
        own = table.get(e) or table.get(e.split(" WITH ")[0]) or Entry("excluded")
        return e, Entry("excluded") if own.status == "allowed" and not own.redistributable else own
    parts = [_verdict(p, table) for p in e[1]]
    place = lambda p: (GROUPS.index(p[1].group) if p[1].group in GROUPS else len(GROUPS), " WITH " in p[0], p[0])
    if e[0] == "OR":
        return min(parts, key=lambda p: (STATUS.index(p[1].status), p[1].attribution, place(p)))
    worst = max((p[1].status for p in parts), key=STATUS.index)
    if worst != "allowed":
        return shown(e), Entry(worst)
    strictest = min(parts, key=lambda p: (not p[1].attribution, place(p)))
    return shown(e), Entry("allowed", strictest[1].group, True, any(p[1].attribution for p in parts))


def class_of(expression: str, table: dict[str, Entry]) -> tuple[str | None, str, str, bool]:
    """(deciding expression, status, group, attribution): OR takes its best branch, AND its strictest; what is malformed or unlisted is excluded."""
    try:
        spdx, e = _verdict(simplified(parsed(expression or "")), table)
    except ValueError:
        return None, "excluded", "", False
    return spdx, e.status, e.group, e.attribution


def with_class(df: DataFrame, expression: str, table: dict[str, Entry]) -> DataFrame:
    """df with spdx, status, grp and attribution of an expression column; each distinct expression is parsed once."""

    @F.pandas_udf("spdx string, status string, grp string, attribution boolean")
    def classes(expressions: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([class_of(x, table) for x in expressions], columns=["spdx", "status", "grp", "attribution"])

    distinct = df.select(expression).where(F.col(expression).isNotNull()).distinct().withColumn("_c", classes(expression))
    return df.join(distinct, expression, "left").select(*df.columns, "_c.spdx", "_c.status", "_c.grp", "_c.attribution")


def with_normalized(df: DataFrame, raw: str, source: str, table: dict[str, str]) -> DataFrame:
    """df with `expression`: what each source wrote, normalised; Python sees each distinct (source, text) once."""

    @F.pandas_udf("string")
    def norm(texts: pd.Series, sources: pd.Series) -> pd.Series:
        return pd.Series([normalized_of(t, s, table) for t, s in zip(texts, sources, strict=True)], dtype="object")

    distinct = df.select(raw, source).distinct().withColumn("expression", norm(raw, source))
    return df.join(distinct.withColumnsRenamed({raw: "_raw", source: "_source"}), F.expr(f"`{raw}` <=> _raw and `{source}` <=> _source"), "left").drop("_raw", "_source")


def cross_checked(facts: DataFrame, family: str, source: str, expression: str, order: list[str], table: dict[str, Entry]) -> DataFrame:
    """By family: the expression of its first source in order, status and group, whether sources disagree, and what none could read.

    facts: one row by family, source and statement, `expression` null where unreadable. A source's
    several statements hold together (AND); one that amounts to NOASSERTION states nothing. Sources that
    differ only in how they exclude a font do not disagree.
    """

    @F.pandas_udf("string")
    def joined(lists: pd.Series) -> pd.Series:
        return lists.map(lambda xs: shown(simplified(parsed(" AND ".join(f"({x})" for x in xs)))))

    stated = facts.where(F.col(expression).isNotNull()).groupBy(family, source).agg(F.array_sort(F.collect_set(expression)).alias("_all"))
    stated = stated.select(family, source, joined("_all").alias("spdx_in")).where(F.col("spdx_in") != NOASSERTION)
    stated = with_class(stated, "spdx_in", table)
    place = F.when(F.array_position(F.array(*[F.lit(s) for s in order]), F.col(source)) > 0, F.array_position(F.array(*[F.lit(s) for s in order]), F.col(source))).otherwise(len(order) + 1)
    by = stated.groupBy(family).agg(
        F.min_by(F.struct(F.col("spdx_in").alias("expression"), "status", "grp"), F.struct(place, source)).alias("_first"),
        ((F.count_distinct("spdx_in") > 1) & F.max(F.col("status") != "excluded")).alias("disagreement"),
    )
    every = facts.groupBy(family).agg(F.count_if(F.col(expression).isNull()).alias("unreadable"))
    out = every.join(by, family, "left")
    return out.select(family, F.col("_first.expression").alias("expression"), F.coalesce("_first.status", F.lit("ruling")).alias("status"), F.coalesce("_first.grp", F.lit("")).alias("grp"), F.coalesce("disagreement", F.lit(False)).alias("disagreement"), "unreadable")


#: First words of licence bodies; what stands before them is a title or a notice.
BODY_STARTS = [
    "preamble the goals of the open font license",
    "preamble this license allows the licensed fonts",
    "definitions license shall mean the terms and conditions",
    "permission is hereby granted",
    "permission to use copy modify",
    "redistribution and use in source and binary forms",
    "creative commons corporation is not a law firm",
    "creative commons corporation creative commons is not a law firm",
    "this is free and unencumbered software",
    "everyone is permitted to copy and distribute verbatim",
    "everyone is allowed to distribute verbatim copies",
    "this software is provided as is without any express or implied warranty",
    "the licensor provides the licensed program",
    "definitions 1 1 contributor means",
    "you are hereby granted permission under all bitstream propriety rights",
    "these fonts are free softwares",
    "licensing agreement for the fonts with original name",
    "as a special exception",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "this work may be distributed and or modified under the conditions of the latex project public license",
]
#: Words that licence lists take for equal, each with the spelling that stands for it, and such pairs.
EQUAL_WORDS = """
acknowledgement acknowledgment, analogue analog, analyse analyze, artefact artifact, authorisation authorization, authorised authorized,
calibre caliber, cancelled canceled, capitalisations capitalizations, catalogue catalog, categorise categorize, centre center,
emphasised emphasized, favour favor, favourite favorite, fulfil fulfill, fulfilment fulfillment, initialise initialize, judgement judgment,
labelling labeling, labour labor, licence license, licences licenses, licenced licensed, licencing licensing, maximise maximize,
merchantibility merchantability, modelled modeled, modelling modeling, offence offense, optimise optimize, organisation organization,
organise organize, practise practice, programme program, realise realize, recognise recognize, signalling signaling, utilisation utilization,
whilst while, wilful wilfull
"""
EQUAL_PAIRS = {"sub license": "sublicense", "non commercial": "noncommercial", "per cent": "percent", "copyright owner": "copyright holder"}
_WORD = r"[\p{L}\p{N}]+"


def _is_notice(line: Column) -> Column:
    """Whether a line (lower case) begins as a copyright notice does: the word, the sign or (c), and then whose or when."""
    marks = F.regexp_extract_all(line, F.lit(r"\(c\)|©|[\[<{]|\p{L}+|\p{N}+"), F.lit(0))

    def begins(marks: Column) -> Column:
        at = lambda k: F.coalesce(F.get(marks, k), F.lit(""))
        skip = F.when(at(F.lit(0)) == "portions", 1).when((at(F.lit(0)) == "digitized") & (at(F.lit(1)) == "data"), 2).otherwise(0)
        first, then = at(skip), at(skip + 1)
        year = then.rlike(r"^\p{N}")
        return (first == "©") | ((first == "(c)") & year) | ((first == "copyright") & (year | then.isin("©", "(c)", "by", "[", "<", "{", "yyyy")))

    return once(marks, begins)


def _without_bullet(line: Column) -> Column:
    """A line without marks and a short number, letter or Roman numeral in front of it, if that ends in a dot or a bracket."""

    def rest(bare: Column) -> Column:
        head = F.substring_index(bare, " ", 1)
        core = F.translate(head, "().", "")
        numbered = core.rlike("^([0-9]{1,2}|[a-z]|[ivx]{1,4})$") & (head.endswith(".") | head.endswith(")")) & (F.length(head) - F.length(core) <= 2)
        return F.when(numbered & (F.length(bare) > F.length(head)), F.substr(bare, F.length(head) + 1)).otherwise(bare)

    return once(F.regexp_replace(line, r"^[\s*•>#-]+", ""), rest)


def _words(line: Column) -> Column:
    """A line's words: addresses are none, and "&" is "and"."""
    pieces = F.split(F.regexp_replace(line, "&", " and "), r"\s+")
    kept = F.filter(pieces, lambda p: ~(p.contains("http://") | p.contains("https://") | p.contains("www.") | p.rlike(r"^\W*[\w.-]+\.(org|com|net|io)(/|\W*$)")))
    return F.regexp_extract_all(F.array_join(kept, " "), F.lit(_WORD), F.lit(0))


def text_print(text: Column, starts: list[str] = BODY_STARTS) -> Column:
    """SHA-256 of a licence text's body: without copyright lines, reserved-name statements, bullets, addresses, case, punctuation and white space, and with one spelling for equal words.

    The body starts at the earliest of `starts`; a text without any of them is taken whole.
    """
    lines = F.filter(F.split(F.regexp_replace(F.lower(text), "^\ufeff", ""), r"\r\n|\r|\n"), lambda x: ~_is_notice(x))
    words = F.transform(lines, lambda x: _words(_without_bullet(x)))
    first = lambda w, k: F.coalesce(F.get(w, F.lit(k)), F.lit(""))
    reserved = lambda w: ((first(w, 0) == "with") & (first(w, 1) == "reserved") & (first(w, 2) == "font")) | ((first(w, 0) == "reserved") & (first(w, 1) == "font") & (first(w, 3) != "refers"))
    equal = dict(pair.split() for pair in " ".join(EQUAL_WORDS.split()).split(", "))
    spelled = F.create_map(*[F.lit(x) for pair in equal.items() for x in pair])
    flat = F.transform(F.flatten(F.filter(words, lambda w: ~reserved(w))), lambda w: F.coalesce(F.try_element_at(spelled, w), w))
    # Each word has a blank on both sides, so that pairs can be met anywhere.
    body = F.concat(F.lit(" "), F.array_join(flat, "  "), F.lit(" "))
    for pair, other in EQUAL_PAIRS.items():
        body = F.replace(body, F.lit(f" {pair.replace(' ', '  ')} "), F.lit(f" {other.replace(' ', '  ')} "))
    body = F.regexp_replace(body, " +", " ")

    def cut(body: Column) -> Column:
        at = F.array_min(F.filter(F.array(*[F.instr(body, F.lit(f" {s} ")) for s in starts]), lambda i: i > 0))
        return F.sha2(F.trim(F.substr(body, F.coalesce(at, F.lit(1)))), 256)

    return once(body, cut)


def mentions(text: Column, phrases: dict[str, str]) -> Column:
    """Names of the phrases whose words stand in the text one after another, sorted.

    A phrase that was found is taken out of the text before shorter ones are looked for, so one inside
    another isn't found with it; phrases are looked for from the longest on.
    """
    flat = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    order = sorted(phrases.items(), key=lambda x: (-len(x[1].split()), -len(x[1]), x[0]))
    start = F.struct(flat.alias("text"), F.array().cast("array<string>").alias("found"))
    listed = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(f" {p} ").alias("phrase")) for n, p in order])
    step = lambda a, x: F.when(a["text"].contains(x["phrase"]), F.struct(F.replace(a["text"], x["phrase"], F.lit(" # ")).alias("text"), F.array_append(a["found"], x["name"]).alias("found"))).otherwise(a)
    return F.array_sort(F.array_distinct(F.aggregate(listed, start, step, lambda a: a["found"])))


def restrictions(text: Column, phrases: list[str]) -> Column:
    """The phrases that the text holds, in their order."""
    flat = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    return F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: flat.contains(F.concat(F.lit(" "), p, F.lit(" "))))
