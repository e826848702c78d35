"""License notices by a positional rare-token index, in Spark SQL expressions alone.

Templates of licence notices are words at positions. The index holds, for each template, its rarest words by document
frequency in the scanned files, with their positions. All indexed words of a file are looked up; a posting at
template position q for a word at file position p proposes that the template starts at p - q. Proposals on which enough
different words agree are verified: every mandatory key phrase of the template must stand at its place.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, whole_text

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]  # mandatory, each standing in the text


# Opening sentences of public licence notices.
TEMPLATES = (
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.", ("gnu general public license", "version 3")),
    Template("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
             "License as published by the Free Software Foundation", ("free software", "gnu general public license")),
    Template("lgpl-notice", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation", ("free software", "gnu lesser general public license")),
    Template("agpl-notice", "You should have received a copy of the GNU Affero General Public License along with this program", ("gnu affero general public license",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    Template("mit", "Released under the MIT License.", ("released under the", "mit license")),
    Template("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files", ("permission is hereby granted", "free of charge")),
    Template("bsd-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met", ("redistribution and use", "with or without modification")),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla public license",)),
    Template("isc-notice", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use", "with or without fee")),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution", "4 0 international")),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", ("licensed under", "cc by nc 4 0")),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0.", ("licensed under", "cc by sa 4 0")),
    Template("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
             ("to the extent possible under law", "related or neighboring rights")),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
)


def template_words(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text))


def file_words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _standing(words: Column, phrase: list[str], at: Column) -> Column:
    """Whether the phrase's words stand from position ``at``."""
    return F.forall(F.array(*[F.struct(F.lit(w).alias("w"), F.lit(i).alias("i")) for i, w in enumerate(phrase)]),
                    lambda p: F.get(words, at + p["i"]).eqNullSafe(p["w"])) & (at >= 0)


def _places(words: Column, phrase: list[str]) -> Column:
    first, *rest = phrase
    hit = lambda i: F.get(words, i) == first

    def every(i: Column) -> Column:
        found = hit(i)
        for k, w in enumerate(rest, 1):
            found = found & F.coalesce(F.get(words, i + k) == w, F.lit(False))
        return found

    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), every)
    # a cheap test of the whole list first: most files lack the phrase's last word
    return F.when(F.size(words) > 0, F.when(F.array_contains(words, rest[-1] if rest else first), places)).otherwise(F.array().cast("array<int>"))


def rarest_words(files: DataFrame, words: str, templates=TEMPLATES, keep: int = 4) -> tuple[dict[str, float], dict[str, list[str]]]:
    """(IDF of every template word, the ``keep`` rarest different words of each template), by document frequency in ``files``."""
    vocabulary = sorted({w for t in templates for w in template_words(t.text)})
    inside = F.array_intersect(F.col(words), F.lit(vocabulary))
    counts = {r["w"]: r["n"] for r in files.select(F.explode(inside).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    total = files.count()
    idf = {w: math.log((total + 1) / (counts.get(w, 0) + 0.5)) for w in vocabulary}
    return idf, {t.label: sorted(set(template_words(t.text)), key=lambda w: (-idf[w], w))[:keep] for t in templates}


def scan_licenses(files: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, base: dict[str, str] = BASE,
                  rare: int = 4, agree: int = 2) -> DataFrame:
    """One row per file: (id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches).

    ``n_base`` counts all places of the base phrases, ``first_word`` and ``last_word`` are the smallest and largest (null without any).
    ``labels`` adds the labels of verified templates to the base ones. ``matches`` lists (label, start, share of the template's words that
    stand at their place). ``score`` is the best share, at least 0.5 with a base phrase, else 0. All indexed words
    of a file are looked up at all their places; ``agree`` different words must propose the same start.
    Null texts are empty: no words, no labels. Null ids and repeated rows are scanned like any row; other columns are not read.
    """
    rows = files.select(F.col(id_col).alias("id"), file_words(whole_text(text_col)).alias("words"))
    idf, index = rarest_words(rows, "words", templates, rare)
    indexed = sorted({w for found in index.values() for w in found}, key=lambda w: (-idf[w], w))
    lengths = {t.label: template_words(t.text) for t in templates}

    # all places of the file's indexed words
    places = F.filter(F.transform("words", lambda w, i: F.when(w.isin(indexed), F.struct(w.alias("w"), i.alias("p")))), lambda x: x.isNotNull())
    rows = rows.withColumn("hits", F.when(F.arrays_overlap("words", F.lit(indexed)), places))

    base_places = {phrase: _places(F.col("words"), phrase.split()) for phrase in base}
    for k, (phrase, found) in enumerate(base_places.items()):
        rows = rows.withColumn(f"b{k}", F.coalesce(found, F.array().cast("array<int>")))
    every = F.concat(*[F.col(f"b{k}") for k in range(len(base))])
    base_labels = F.array_distinct(F.array_compact(F.array(*[F.when(F.size(f"b{k}") > 0, label) for k, label in enumerate(base.values())])))

    def matches(template: Template) -> Column:
        words, rarest = lengths[template.label], index[template.label]
        enough = min(agree, len(rarest))
        # of any ``enough`` words that agree one at least is among these, so they propose all starts
        postings = [(w, q) for q, w in enumerate(words) if w in rarest[:len(rarest) - enough + 1]]
        starts = F.flatten(F.transform("hits", lambda x: F.array_compact(F.array(*[F.when(x["w"] == w, x["p"] - q) for w, q in postings]))))

        def support(at: Column) -> Column:
            stands = [[F.get(F.col("words"), at + q).eqNullSafe(w) for q, x in enumerate(words) if x == w] for w in rarest]
            return sum(F.when(reduce(or_, places), 1).otherwise(0) for places in stands)

        agreed = F.filter(F.array_distinct(starts), lambda at: support(at) >= enough)

        def verified(at: Column) -> Column:
            ok = F.lit(True)
            for phrase in template.phrases:
                parts = phrase.split()
                q = next(i for i in range(len(words)) if words[i:i + len(parts)] == parts)
                ok = ok & _standing(F.col("words"), parts, at + q)
            return ok

        share = lambda at: F.size(F.filter(
            F.transform(F.lit(words), lambda w, i: F.get(F.col("words"), at + i).eqNullSafe(w)), lambda x: x)) / len(words)
        found = F.transform(F.filter(agreed, verified), lambda at: F.struct(F.lit(template.label).alias("label"), at.cast("long").alias("start"), share(at).alias("share")))
        return F.when(F.size("hits") >= enough, found).otherwise(F.array().cast("array<struct<label:string,start:bigint,share:double>>"))

    rows = rows.select("id", F.size("words").cast("long").alias("n_words"), every.alias("places"), base_labels.alias("base"),
                       F.flatten(F.array(*[matches(t) for t in templates])).alias("matches"))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("matches", lambda m: m["label"]))))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0))
    return rows.select(
        F.col("id").alias(id_col), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(best, F.when(F.size("places") > 0, 0.5).otherwise(0.0)).alias("score"), "matches")
