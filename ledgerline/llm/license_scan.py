"""License scan: an exact set-similarity join with DataFrame functions only.

A template is the set of words of a license notice. The words of every
document, in overlapping windows that run across line feeds, are its blocks. A
block meets a template when some stretch of it, ``span`` times as many words
long as the notice, holds at least ``containment`` of the template's words: a
notice is met however its lines are broken, words scattered over the block are
not. Words are put in one global order, from rarest to most frequent over all
documents, and a pair is looked at only if

* length: the block has as many words of the vocabulary as are needed,
* prefix: one of the first |T| - needed + 1 words of the template, in that
  order, is in the block (an equality join on the word), and
* position: the words from there on can still make up what is needed.

The places of the words are looked at in the pairs that are left.

Words outside all templates cannot add to an overlap, so blocks are kept as
their vocabulary words. The template side is a list in this module, hence
broadcast; blocks are never shuffled, only documents with hits are grouped.

Besides, phrases are counted where their words stand consecutively.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import long_id, materialize, text_or_empty

#: Words: runs of digits, letters and all that is not ASCII (A-Z as yet in).
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrase and base label (fixed values).
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Label and wording of license notices (fixed values).
TEMPLATES = (
    ("agpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                    "GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache-notice", "Licensed under the Apache License, Version 2.0"),
    ("apache-terms", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("bsd-terms", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-terms", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                  "GNU General Public License as published by the Free Software Foundation"),
    ("isc-terms", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                  "is hereby granted"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-terms", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mpl-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)


def _template_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()


def _word_set(text: str) -> list[str]:
    return sorted(set(_template_words(text)))


def _lower(text: str) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, UPPER, LOWER)


def phrase_places(words: str, phrase: str) -> Column:
    """Places, as numbers from 0 in the words column (NULL: none), where the
    phrase's words stand consecutively."""
    parts = phrase.split()
    n = len(parts)
    here = F.filter(F.sequence(F.lit(0), F.size(words) - n),
                    lambda i: F.slice(words, i + 1, n) == F.array(*map(F.lit, parts)))
    return F.when(F.size(words) >= n, here).otherwise(F.array().cast("array<int>"))


def may_hold(text: str, phrase: str) -> Column:
    return F.col(text).rlike("(?i)" + f"{NOT_WORD}+".join(phrase.split()))


def windows_of(docs: DataFrame, vocabulary: list[str], width: int) -> DataFrame:
    """``(id, h, no, seen)``: the vocabulary words of each window of the whole
    text with their places, and the window's number. Windows are two runs of
    ``width // 2`` words in a row; any run of so many words lies whole in one."""
    step = width // 2

    def run(i: Column) -> Column:
        return F.filter(F.transform(F.slice("w", i * step + 1, step), lambda x, j: F.when(
            x.isin(vocabulary), F.struct((i * step + j).alias("at"), x.alias("word")))), lambda s: s.isNotNull())

    runs = F.transform(F.sequence(F.lit(0), F.expr(f"(size(w) - 1) div {step}").cast("int")), run)
    pairs = F.when(F.size("runs") == 1, F.col("runs")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size("runs") - 1, F.lit(1))),
                    lambda i: F.concat(F.element_at("runs", i), F.element_at("runs", i + 1))))
    return docs.select("id", "h", F.split(_lower("text"), f"{NOT_WORD}+").alias("w")) \
        .select("id", "h", runs.alias("runs")).select("id", "h", F.posexplode(pairs).alias("no", "seen"))


def lines_of(docs: DataFrame, vocabulary: list[str], width: int) -> DataFrame:
    """``(id, h, no, block)``: the vocabulary words of each line, or of each
    window of a very long one, each once, and a number."""
    words = F.split(_lower("line"), f"{NOT_WORD}+")
    step = width // 2
    windows = F.when(F.size("w") <= width, F.array("w")).otherwise(
        F.transform(F.sequence(F.lit(0), F.expr(f"(size(w) - {step} - 1) div {step}").cast("int")),
                    lambda i: F.slice("w", i * step + 1, width)))
    return docs.select("id", "h", F.posexplode(F.split("text", "\n")).alias("line_no", "line")) \
        .select("id", "h", "line_no", words.alias("w")).select("id", "h", "line_no", F.posexplode(windows).alias("part", "w")) \
        .select("id", "h", F.struct("line_no", "part").alias("no"),
                F.array_distinct(F.filter("w", lambda x: x.isin(vocabulary))).alias("block"))


def template_hits(docs: DataFrame, templates, containment: float, width: int, span: float | None) -> DataFrame:
    """``(id, h, labels, best)`` of the documents with a block that meets a
    template, with the labels its blocks meet; ``docs`` has id, h, text.

    A block gives the labels of all templates it meets, but for those that it
    gives no word of its own: where all words it shares with a template (in
    stretches that meet it) it also shares with one it meets better, as CC
    BY-NC but for "nc" is also most of CC BY-SA, only the better one counts."""
    spark = docs.sparkSession
    sets = {label: _word_set(text) for label, text in templates}
    lengths = {label: len(_template_words(text)) for label, text in templates}
    vocabulary = sorted(set().union(*sets.values()))
    if not all(lengths.values()) or max(lengths.values()) * max(span or 1, 1) > width // 2:
        raise ValueError("a template must have words, and a stretch of it at most half a window of them")
    frequency = docs.select(F.explode(F.split(_lower("text"), f"{NOT_WORD}+")).alias("word")) \
        .filter(F.col("word").isin(vocabulary)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    frequency = dict(frequency.collect())  # at most the vocabulary of the templates
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}
    rank = F.create_map(*[x for w, i in order.items() for x in (F.lit(w), F.lit(i))])
    needs = {label: math.ceil(len(t) * containment - 1e-9) for label, t in sets.items()}
    rows = [F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, sorted(order[w] for w in t))).alias("words"),
                     F.lit(needs[label]).alias("needed"), F.lit(int(lengths[label] * (span or 1))).alias("stretch"))
            for label, t in sets.items()]
    prefix = spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*") \
        .select("*", F.posexplode("words").alias("at", "word")).filter(F.col("at") <= F.size("words") - F.col("needed"))
    leading = sorted(set().union(*(sorted(order[w] for w in t)[:len(t) - needs[a] + 1] for a, t in sets.items())))
    if span is None:
        blocks = lines_of(docs, vocabulary, width).withColumn("seen", F.lit(None))
    else:
        blocks = windows_of(docs, vocabulary, width).withColumn("block", F.array_distinct(F.col("seen.word")))
    blocks = blocks.filter(F.size("block") >= min(needs.values())) \
        .withColumn("block", F.array_sort(F.transform("block", lambda w: rank[w])))
    places = F.filter(F.transform("block", lambda w, i: F.struct(i.alias("place"), w.alias("word"))),
                      lambda s: s["word"].isin(leading))
    found = blocks.withColumn("s", F.explode(places)).select("*", "s.place", "s.word") \
        .join(F.broadcast(prefix), "word") \
        .filter(F.size("block") >= F.col("needed")) \
        .filter(F.least(F.size("words") - F.col("at"), F.size("block") - F.col("place")) >= F.col("needed")) \
        .withColumn("shared", F.array_intersect("block", "words")).filter(F.size("shared") >= F.col("needed")) \
        .withColumn("most", F.size("shared"))
    if span is not None:
        own = F.filter(F.transform("seen", lambda s: F.struct(s["at"].alias("at"), rank[s["word"]].alias("word"))),
                       lambda s: F.array_contains("words", s["word"]))
        stretches = F.transform("own", lambda s: F.array_distinct(F.transform(
            F.filter("own", lambda e: (e["at"] >= s["at"]) & (e["at"] < s["at"] + F.col("stretch"))), lambda e: e["word"])))
        found = found.withColumn("own", own) \
            .withColumn("meet", F.filter(stretches, lambda p: F.size(p) >= F.col("needed"))).filter(F.size("meet") > 0) \
            .withColumn("shared", F.array_distinct(F.flatten("meet"))) \
            .withColumn("most", F.array_max(F.transform("meet", lambda p: F.size(p))))
    share = (F.col("most") / F.size("words")).alias("share")
    met = found.select("id", "h", "no", F.struct("label", share, F.array_sort("shared").alias("shared")).alias("m")) \
        .groupBy("id", "h", "no").agg(F.collect_set("m").alias("met"))
    own = F.filter("met", lambda m: ~F.exists("met", lambda n: (n["share"] > m["share"]) & (
        F.size(F.array_except(m["shared"], n["shared"])) == 0)))
    return met.select("id", "h", F.explode(own).alias("m")).groupBy("id", "h").agg(
        F.collect_set("m.label").alias("labels"), F.max("m.share").alias("best"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES,
                  templates=TEMPLATES, containment: float = 0.8, width: int = 512,
                  span: float | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score.

    n_base counts the places of all phrases; first_word and last_word are the
    smallest and largest, NULL if there is none. labels adds the labels of
    the templates met to the base ones; both are distinct, sorted and joined
    by commas, empty if there are none; all templates that a block meets give
    their label, but for those without a word of their own, see
    :func:`template_hits`. score is 1 with a place of a phrase,
    else the largest share of a template met, else 0. With ``span``, as
    registered, blocks run over the whole text, line feeds being white space,
    and what meets a template of n words stands within ``span`` * n words; without,
    each line is by itself and its words may stand anywhere in it. NULL text counts as
    empty, NULL ids stay, repeated rows are scanned alike; other columns are
    ignored; empty in, empty out."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), long_id(id_col).alias("id"),
                       text_or_empty(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    hits = materialize(template_hits(rows, templates, containment, width, span), "license-hits")
    some = reduce(Column.__or__, (may_hold("text", p) for p, _ in phrases))
    split = F.split("text", f"{NOT_WORD}+")
    count = F.size("w") - (F.element_at("w", 1) == "").cast("int") \
        - ((F.size("w") > 1) & (F.element_at("w", -1) == "")).cast("int")
    own = rows.select("doc_id", "id", "h", split.alias("w"), F.when(some, F.col("text")).alias("text")) \
        .select("doc_id", "id", "h", count.cast("long").alias("n_words"),
                F.filter(F.split(_lower("text"), f"{NOT_WORD}+"), lambda w: w != "").alias("w"))
    own = own.select("doc_id", "id", "h", "n_words", F.array(*(
        F.struct(F.lit(label).alias("label"), phrase_places("w", p).alias("at")) for p, label in phrases)).alias("found"))
    own = own.select("doc_id", "id", "h", "n_words", F.filter("found", lambda f: F.size(f["at"]) > 0).alias("found")) \
        .select("doc_id", "id", "h", "n_words", F.flatten(F.col("found.at")).alias("places"),
                F.array_sort(F.array_distinct(F.col("found.label"))).alias("base"))
    both = own.join(hits, ["id", "h"], "left")
    extra = F.coalesce("labels", F.array().cast("array<string>"))
    return both.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", extra)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
