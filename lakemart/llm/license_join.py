"""License scans: an exact set-similarity join of text blocks with license templates, by built-in functions only.

A block matches a template if it holds at least ``threshold`` of the template's distinct words.  Blocks are sentences, lines,
and every run of as many consecutive words as the template has (all words, if there are fewer), across line breaks and
sentence ends.  Words are ordered by their frequency in all documents, rarest first.  A template of n words that needs k of
them is met only in texts that hold one of its first n - k + 1 words (prefix filter), that have k template words at all
(length filter), and whose words from the first common one on still suffice on both sides (positional filter).
Blocks are formed of the texts that are left, for the templates that are left, and counted exactly.

Templates of other labels whose own text would meet a template are its siblings.  A block must hold the words that tell a
template from its siblings ("lesser", "nc"), and none by which a sibling goes beyond it.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.texts import stored

#: A word is a run of these; white space, punctuation and other ASCII characters lie between (texts are lower-cased).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: The same in lower-cased text, as Java's matcher tells it fastest.
IN_WORD = r"[0-9a-z\x80-\x{10FFFF}]"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
BLOCK_END = r"\n|(?<=[.!?])\s"

WANTED = "struct<label string, need int, length int, words array<string>, must array<string>, must_not array<string>>"

#: Phrases that always give a label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Well-known license statements and their labels.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("lgpl", "Licensed under the GNU Lesser General Public License."),
    ("agpl", "Licensed under the GNU Affero General Public License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("reserved", "Copyright, all rights reserved."),
]


def words(text: Column) -> Column:
    """The words of a lower-cased text in order."""
    return F.filter(F.split(text, BETWEEN + "+"), lambda w: w != "")


def phrase(text: str) -> str:
    """A pattern for the words of a phrase in direct succession, in lower-cased text.

    It looks for the first word before it looks at what is in front of it, which most places don't come to.
    """
    first, *others = text.split()
    return f"{BETWEEN}+".join([f"{first}(?<!{IN_WORD}{first})", *others]) + f"(?!{IN_WORD})"


def base_columns(text: Column) -> dict[str, Column]:
    """n_words, n_base, first_word, last_word and base_labels of a lower-cased text."""
    count = lambda x: F.regexp_count(x, F.lit(IN_WORD + "+")).cast("bigint")
    # Few texts hold all words of a phrase; only those are searched.
    might = {p: reduce(and_, [text.contains(w) for w in p.split()]) for p in PHRASES}
    places = {label: F.when(might[p], F.regexp_count(text, F.lit(phrase(p)))).otherwise(0) for p, label in PHRASES.items()}
    anything = "|".join(map(phrase, PHRASES))
    n_base = sum(places.values(), F.lit(0)).cast("bigint")
    gaps = F.split(text, anything, -1)
    last_match = F.element_at(F.regexp_extract_all(text, F.lit(anything), F.lit(0)), -1)
    return {
        "n_words": count(text),
        "n_base": n_base,
        "first_word": F.when(n_base > 0, count(gaps[0])),
        "last_word": F.when(n_base > 0, count(text) - count(F.element_at(gaps, -1)) - count(last_match)),
        "base_found": F.filter(F.array(*[F.when(n > 0, F.lit(label)) for label, n in sorted(places.items())]), lambda x: x.isNotNull()),
    }


def telling_words(templates: list[tuple[str, set[str]]], threshold: float) -> list[tuple[set[str], set[str]]]:
    """For each template ``(label, words)``, the words that a block must and must not hold, from its siblings."""
    found = []
    for label, own in templates:
        siblings = [w for other, w in templates if other != label and len(own & w) >= threshold * len(own) - 1e-9]
        found.append((set().union(*(own - w for w in siblings)), set().union(*(w - own for w in siblings if own <= w))))
    return found


def text_matches(docs: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """The rows of ``docs`` with each template (``wanted``) of which they hold ``threshold`` of the words anywhere in ``lowered``."""
    spark = docs.sparkSession
    split = [list(filter(None, re.split(BETWEEN + "+", text.lower()))) for _, text in templates]
    vocabulary = sorted(set().union(*split))  # of the fixed templates
    counted = docs.select(F.explode(F.split("lowered", BETWEEN + "+")).alias("word")).where(F.col("word").isin(vocabulary)).groupBy("word").count()
    frequency = {r["word"]: r["count"] for r in counted.collect()}  # as many rows as the templates have words
    place = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}
    rows = []
    telling = telling_words([(label, set(own)) for (label, _), own in zip(templates, split, strict=True)], threshold)
    for (label, _), own, (must, must_not) in zip(templates, split, telling, strict=True):
        places = sorted(place[w] for w in set(own))
        need = math.ceil(threshold * len(places) - 1e-9)
        wanted = (label, need, len(own), sorted(set(own)), sorted(must), sorted(must_not))
        rows += [(p, at, places, wanted) for at, p in enumerate(places[: len(places) - need + 1])]
    # One row for each prefix word of the fixed templates.
    prefixes = spark.createDataFrame(rows, f"place int, at int, places array<int>, wanted {WANTED}")
    starts = sorted(w for w, p in place.items() if p in {r[0] for r in rows})
    # A word's place by a map of the template words; others are not looked at.
    places = F.create_map(*[x for w, p in place.items() for x in (F.lit(w), F.lit(p))])
    found = docs.withColumn("words", F.split("lowered", BETWEEN + "+")).where(F.arrays_overlap("words", F.array(*map(F.lit, starts))))
    known = F.array_sort(F.transform(F.array_intersect("words", F.array(*map(F.lit, vocabulary))), lambda w: places[w]))
    keyed = found.withColumn("known", known).select(*docs.columns, "known", F.posexplode("known").alias("j", "place"))
    need, common = F.col("wanted.need"), F.array_intersect("known", "places")
    pairs = keyed.join(F.broadcast(prefixes), "place").where(
        (F.size("known") >= need) & (F.least(F.size("places") - F.col("at"), F.size("known") - F.col("j")) >= need - F.col("at"))
    )
    # A pair that shares several prefix words is taken by the first.
    return pairs.where((F.size(common) >= need) & (common[0] == F.col("place"))).select(*docs.columns, "wanted")


def block_matches(docs: DataFrame, templates: list[tuple[str, str]], threshold: float, keep: list[str]) -> DataFrame:
    """``keep``, label and containment of each block of ``docs(keep, lowered)`` that meets a template."""
    pairs = text_matches(docs, templates, threshold)
    length = F.col("wanted.length")
    block_words = F.transform(F.split("lowered", BLOCK_END), lambda block: F.split(block, BETWEEN + "+"))
    # Stretches of two lengths, one length apart, hold every run of one length.
    all_words = pairs.withColumn("words", words(F.col("lowered"))).where(F.size("words") > 0)
    steps = F.sequence(F.lit(0), F.floor((F.size("words") - 1) / length).cast("int"))
    stretches = all_words.select(*keep, "wanted", F.explode(F.transform(steps, lambda k: F.slice("words", k * length + 1, 2 * length))).alias("stretch"))
    stretches = stretches.where(F.size(F.array_intersect("stretch", "wanted.words")) >= F.col("wanted.need"))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("stretch") - length + 1, F.lit(1))), lambda i: F.slice("stretch", i, length))
    blocks = pairs.select(*keep, "wanted", F.explode(block_words).alias("block")).unionByName(stretches.select(*keep, "wanted", F.explode(runs).alias("block")))
    overlap = F.size(F.array_intersect("block", "wanted.words"))
    told = (F.size(F.array_intersect("block", "wanted.must")) == F.size("wanted.must")) & ~F.arrays_overlap("block", "wanted.must_not")
    met = blocks.where((overlap >= F.col("wanted.need")) & told)
    return met.select(*keep, "wanted.label", (overlap / F.size("wanted.words")).alias("containment"))


def license_scan(docs: DataFrame, text: str = "text", id_col: str = "doc_id", templates: list[tuple[str, str]] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """For each row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    base_* come from ``PHRASES``; labels adds those of the templates that a block meets.  score is the greatest
    containment, 1 where a phrase stands, 0 where nothing is found.  NULL and empty texts have no words and no labels.
    Rows that repeat doc_id and text get the same result each; other rows with that doc_id their own.  NULL ids are
    kept, an empty table gives an empty one, further columns are not read.
    """
    lowered = F.lower(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), lowered.alias("lowered"))
    own = own.withColumn("text_hash", F.xxhash64("lowered"))
    base = own.select("doc_id", "text_hash", *[c.alias(n) for n, c in base_columns(F.col("lowered")).items()])
    met = block_matches(own, templates, threshold, ["doc_id", "text_hash"])
    met = met.groupBy("doc_id", "text_hash").agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    met = stored(met.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "found", "best"), "licenses")
    both = base.join(met, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    labels = F.array_sort(F.array_union("base_found", F.coalesce("found", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_found", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"),
    )
