"""Licence scan by a positional index of rare words (native: DataFrame operations only).

Every template's words are ranked by their inverse document frequency over the whole corpus; its
rarest ones, with their places in the template, are the index. All indexed words that a file has, the
rarest first, are looked up; a posting at template place p found at file place i votes for a start of
i - p, and a template matches where enough of its indexed words vote for one start and its mandatory
key phrase stands in the file. The places of three base phrases are reported as well. Texts are taken
apart once: the words of files that may match, and which of the templates' words every file has, are
written, and both the frequencies and the matches come from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import body, written

#: Separators between words, once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Licence wordings, as (label, words of the template, mandatory key phrase).
WORDINGS = [
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "you may not use this file except in compliance with the license", "compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "source and binary forms"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("bsl", "boost software license version 1 0", "boost software license"),
    ("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by", "creative commons attribution license", "creative commons attribution license"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by", "cc by 3 0", "cc by 3 0"),
    ("cc-by-nc", "cc by nc", "cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial", "creative commons attribution noncommercial"),
    ("cc-by-sa", "cc by sa", "cc by sa"),
    ("cc-by-sa", "creative commons attribution sharealike", "creative commons attribution sharealike"),
    ("cc0", "cc0 1 0 universal", "cc0 1 0"),
    ("epl", "eclipse public license version 2 0", "eclipse public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "redistribute it and or modify it"),
    ("gpl", "under the terms of the gnu general public license", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", "the software is provided as is"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl", "mozilla public license version 2 0", "mozilla public license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
    ("ofl", "sil open font license version 1 1", "open font license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("wtfpl", "do what the fuck you want to public license", "you want to public license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "in no event will the authors be held liable"),
]
#: Words of licence identifiers behind "SPDX-License-Identifier:".
IDENTIFIERS = {"agpl": "agpl", "apache": "apache 2 0", "artistic": "artistic 2 0", "bsd": "bsd", "bsl": "bsl 1 0", "cc-by": "cc by 4 0", "cc-by-sa": "cc by sa", "cc-by-nc": "cc by nc", "cc0": "cc0 1 0", "epl": "epl", "gpl": "gpl", "isc": "isc", "lgpl": "lgpl", "mit": "mit", "mpl": "mpl", "ofl": "ofl 1 1", "unlicense": "unlicense", "wtfpl": "wtfpl", "zlib": "zlib"}
TEMPLATES = WORDINGS + [(label, f"spdx license identifier {words}", f"license identifier {words}") for label, words in IDENTIFIERS.items()]
#: Indexed words of a template: one in so many of its different ones, so many at least.
RARE_SHARE, RARE_LEAST = 4, 4
#: Share of a template's indexed words that must agree on a start.
AGREE = 0.75


def words_of(text: Column) -> Column:
    """Words of a text in order; an empty array for a text without words."""
    # Case differs from letter to letter only; other letters that lower() changes stay word characters.
    spaced = F.trim(F.regexp_replace(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), SEPARATORS, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def places(words: Column, phrase: str) -> Column:
    """Starts, from 0, of the places where the phrase's words stand consecutively."""
    parts = phrase.split(" ")
    last = F.size(words) - len(parts)

    def here(i: Column) -> Column:
        out = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            out = out & (F.get(words, i + k) == part)
        return out

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words, no labels and score 0. Repeated rows and ids are scanned
    each for itself; an empty table gives an empty result. score is the best template's share of
    agreeing indexed words (1 where only a base phrase stands).
    """
    spark = docs.sparkSession
    templates = [(k, label, t.split(" "), phrase) for k, (label, t, phrase) in enumerate(TEMPLATES)]
    vocabulary = sorted({w for _, _, t, _ in templates for w in t} | {w for p in BASE for w in p.split(" ")})
    known = F.array(*[F.lit(w) for w in vocabulary])
    # Every match needs a key or base phrase; of each phrase its longest word is looked for.
    needed = F.array(*[F.lit(w) for w in sorted({max(p.split(" "), key=lambda w: (len(w), w)) for p in [*BASE, *(phrase for _, _, _, phrase in templates)]})])
    # Bounded tables: the templates are fixed.
    postings = spark.createDataFrame([(k, w, p) for k, _, t, _ in templates for p, w in enumerate(t)], "template int, word string, at int")

    words = docs.select(F.col(id_col).alias("doc_id"), words_of(body(text_col)).alias("words"))
    words = words.withColumn("hits", F.array_intersect("words", known)).withColumn("may", F.arrays_overlap("hits", needed))
    base = words.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"), "hits", F.when(F.col("may"), F.col("words")).alias("words"))
    base = written(base, "license-words")
    found = base.where(F.col("words").isNotNull())

    frequency = base.select(F.explode("hits").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df")).collect()  # words of the templates
    df = {r["word"]: r["df"] for r in frequency}
    index = {}
    for k, _, t, _ in templates:
        own = sorted(dict.fromkeys(t), key=lambda w: (df.get(w, 0), w))
        index[k] = own[: max(RARE_LEAST, len(own) // RARE_SHARE)]
    rare = sorted({w for ws in index.values() for w in ws}, key=lambda w: (df.get(w, 0), w))

    # The array lists the index from its rarest word on, so the file's words come in falling IDF.
    looked_up = F.array(*[F.lit(w) for w in rare])
    own = found.select("row", "words", F.array_intersect(looked_up, F.col("hits")).alias("own"))
    spots = own.select("row", F.posexplode("words").alias("i", "word"), "own").where(F.array_contains("own", F.col("word"))).select("row", "i", "word")
    entries = postings.join(F.broadcast(spark.createDataFrame([(k, w) for k, ws in index.items() for w in ws], "template int, word string")), ["template", "word"])
    votes = (
        spots.join(F.broadcast(entries), "word")
        .groupBy("row", "template", (F.col("i") - F.col("at")).alias("start"))
        .agg(F.count_distinct("word").alias("agree"))
    )
    best = votes.groupBy("row", "template").agg(F.max("agree").alias("agree"))
    facts = spark.createDataFrame([(k, label, f" {phrase} ", len(index[k])) for k, label, _, phrase in templates], "template int, label string, phrase string, indexed int")
    best = best.join(F.broadcast(facts), "template").where(F.col("agree") >= F.ceil(F.lit(AGREE) * F.col("indexed")))
    matched = (
        best.join(found, "row")
        .where(F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).contains(F.col("phrase")))
        .groupBy("row")
        .agg(F.collect_set("label").alias("more"), F.max(F.col("agree") / F.col("indexed")).alias("share"))
    )

    at = {p: places(F.col("words"), p) for p in BASE}
    spans = found.select("row", *[at[p].alias(f"p{k}") for k, p in enumerate(BASE)])
    every = F.concat(*[F.col(f"p{k}") for k in range(len(BASE))])
    named = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, label in enumerate(BASE.values())]))
    spans = spans.select("row", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), named.alias("base"))
    none = F.array().cast("array<string>")
    return (
        base.select("row", "doc_id", "n_words")
        .join(spans, "row", "left")
        .join(matched, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
            "first_word",
            "last_word",
            F.array_join(F.array_sort(F.coalesce("base", none)), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union(F.coalesce("base", none), F.coalesce("more", none))), ",").alias("labels"),
            F.coalesce("share", F.when(F.coalesce("n_base", F.lit(0)) > 0, 1.0).otherwise(0.0)).cast("double").alias("score"),
        )
    )


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    from plumbline.llm.common import table

    return scan(table(spark, sf_dir, "documents"))


