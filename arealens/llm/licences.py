"""Licence notices in text. DataFrame functions only.

Method: texts are brought to lower-case words and compared to licence templates by Dice's
coefficient over bags of word bigrams: twice the shared bigrams over the sum of both numbers.
At a coefficient of t a region of n bigrams can only match templates of n * t / (2 - t) to
n * (2 - t) / t bigrams, so most regions meet no template at all. Regions are the lines of a
text, and, for notices inside a line or over several, windows of a template's length, placed
by each of its telling bigrams that the text holds. A region that matches a template of s
bigrams holds at least s * t / (2 - t) of them, so a text without any of s - s * t / (2 - t) + 1
chosen ones is not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 0.8
ANCHORS = 3
SPAN = 1 << 24
BROADCAST_ROWS = 50_000
#: Words of which two in a row tell nothing of a licence.
COMMON = frozenset("a above all an and any are as at be by copies do following for from free have has if in is it limitation may no not of on or "
                   "other over person provided so subject such that the this to under use version whom with without work you".split())

#: Usual notices of well-known licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
            "the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                         "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                     "conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """(template, licence, size, bigram, times): the bigrams of each template and its number of bigrams; broadcast if short."""
    rows = []
    for n, (licence, text) in enumerate(templates):
        words = template_words(text)
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        rows += [(n, licence, len(pairs), p, pairs.count(p)) for p in sorted(set(pairs))]
    table = spark.createDataFrame(rows, "template int, licence string, size int, bigram string, times int")
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table


def _anchors(words: list[str], least: float) -> tuple[list[int], list[int]]:
    """Places of a template's bigrams: enough that any match holds one, and all that place windows.

    The first `ANCHORS` and all that are not two common words place windows.
    """
    size = len(words) - 1
    by = sorted(range(size), key=lambda j: ((words[j] in COMMON) + (words[j + 1] in COMMON), j))
    enough = size - ceil(size * least / (2 - least) - 1e-9) + 1
    telling = [j for j in by if not (words[j] in COMMON and words[j + 1] in COMMON)]
    return by[:enough], sorted({*by[:enough], *telling, *range(min(ANCHORS, size))})


def _places(templates: tuple[tuple[str, str], ...], least: float) -> tuple[dict[str, list[int]], list[str]]:
    """Where bigrams place windows, as place in the template and its length in one number; and those of which a text with a match must hold one."""
    places: dict[str, list[int]] = {}
    needed: set[str] = set()
    for _, text in templates:
        words = template_words(text)
        enough, every = _anchors(words, least)
        for j in every:
            places.setdefault(f"{words[j]} {words[j + 1]}", []).append(j * SPAN + len(words))
        needed |= {f"{words[j]} {words[j + 1]}" for j in {*enough, *range(min(ANCHORS, len(words) - 1))}}
    return {p: sorted(set(v)) for p, v in places.items()}, sorted(needed)


def _windows(words: Column, templates: tuple[tuple[str, str], ...], least: float, region: Callable[[Column, Column], Column]) -> Column:
    """The pieces of a text, given as words, that have a template's length around one of its bigrams. Its bigrams are looked up once each."""
    places, needed = _places(templates, least)
    known = F.create_map(*[c for p, spans in places.items() for c in (F.lit(p), F.array(*[F.lit(v).cast("long") for v in spans]))])

    def of(w: Column) -> Column:
        def pair(i: Column) -> Column:
            return F.concat(w[i], F.lit(" "), w[i + 1])

        def span(i: Column, v: Column) -> Column:
            """First word and number of words of a window, clipped to the text, in one number."""
            first = i - F.floor(v / SPAN)
            start = F.greatest(first, F.lit(0))
            return start * SPAN + F.least(first + v % SPAN, F.size(w)) - start

        def around(hits: Column) -> Column:
            spans = F.array_distinct(F.flatten(F.transform(hits, lambda i: F.transform(F.element_at(known, pair(i)), lambda v: span(i, v)))))
            return F.transform(spans, lambda v: region(F.slice(w, (F.floor(v / SPAN) + 1).cast("int"), (v % SPAN).cast("int")), (v % SPAN - 1).cast("int")))

        hits = F.filter(F.sequence(F.lit(0), F.size(w) - 2), lambda i: pair(i).isin(list(places)))
        return F.transform(F.array(hits), lambda h: F.when(F.exists(h, lambda i: pair(i).isin(needed)), around(h)))[0]

    return F.coalesce(F.when(F.size(words) > 1, F.transform(F.array(words), of)[0]), F.filter(F.array(region(words, F.lit(0))), lambda r: F.lit(False)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES,
         least: float = LEAST) -> DataFrame:
    """Licences found in documents: (doc_id, licence, dice, notices).

    `dice` is the best coefficient, at least `least`, and `notices` the number of lines that
    match, at least 1. A line or window counts for its best template only, of equal ones the
    first. Rows that share an id are taken together, null ids too; null, empty and blank
    texts hold nothing; an empty table gives an empty table; other columns are ignored.
    """
    text = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    plain = F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " ")
    sizes = sorted({len(template_words(t)) - 1 for _, t in templates})

    def line(x: Column) -> Column:
        words = F.trim(x)
        spaces = F.char_length(words) - F.char_length(F.translate(words, " ", ""))
        return F.struct(F.lit(True).alias("line"), words.alias("words"), spaces.alias("n"))

    def window(words: Column, n: Column) -> Column:
        return F.struct(F.lit(False).alias("line"), F.array_join(words, " ").alias("words"), n.alias("n"))

    def fits(r: Column) -> Column:
        """Whether some template has a size within the bounds."""
        near = [(r["n"] * (2 - least) >= s * least) & (r["n"] * least <= s * (2 - least)) for s in sizes]
        return reduce(lambda a, b: a | b, near)

    def regions_of(p: Column) -> Column:
        lines = F.transform(F.split(p, "\n"), line)
        words = F.split(F.trim(F.regexp_replace(p, r"[ \n]+", " ")), " ")
        return F.filter(F.concat(lines, _windows(words, templates, least, window)), lambda r: fits(r))

    every = F.flatten(F.transform(F.array(plain), lambda p: regions_of(p)))
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), every.alias("every"))
    sized = own.select("row", "doc_id", F.posexplode("every").alias("at", "region")).select(
        "row", "doc_id", "at", "region.line", F.split("region.words", " ").alias("words"), "region.n")
    words = F.col("words")
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    grams = sized.select("row", "doc_id", "at", "line", "n", F.explode(F.slice(pairs, F.lit(1), F.col("n"))).alias("bigram"))
    table = template_table(docs.sparkSession, templates)
    close = (F.col("n") * (2 - least) >= F.col("size") * least) & (F.col("n") * least <= F.col("size") * (2 - least))
    shared = grams.join(table, "bigram").where(close).groupBy("row", "doc_id", "at", "line", "n", "template", "licence", "size", "bigram", "times").agg(
        F.count(F.lit(1)).alias("own"))
    dice = shared.groupBy("row", "doc_id", "at", "line", "n", "template", "licence", "size").agg(F.sum(F.least("own", "times")).alias("both"))
    dice = dice.withColumn("dice", 2.0 * F.col("both") / (F.col("n") + F.col("size"))).where(F.col("dice") >= least)
    best = dice.groupBy("row", "doc_id", "at", "line").agg(F.max(F.struct("dice", (-F.col("template")).alias("first"), "licence")).alias("b"))
    found = best.groupBy("doc_id", F.col("b.licence").alias("licence")).agg(
        F.max("b.dice").alias("dice"), F.greatest(F.sum(F.col("line").cast("long")), F.lit(1)).alias("notices"))
    return found.select("doc_id", "licence", "dice", "notices")
