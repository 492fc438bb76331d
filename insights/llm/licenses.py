"""License scans: exact set-similarity join of text blocks with license notices
(DataFrame operations only).

Blocks are windows of as many consecutive words of a text as a template has, line ends
or not, for that template alone, as sets of words (A-Z lower-cased).  A block meets its
template when it holds at least ``threshold`` of the template's words, all words that its
label can't do without (``needed``) and none that belongs to another (``barred``). Words
outside all templates can't add to an overlap, so blocks are projected to the
template vocabulary, a fixed set, and only texts that hold enough words of a template
and its needed ones as a whole are cut into blocks; then

* the words of that vocabulary are put in the order of the number of documents that
  hold them, over all documents, rarest first;
* prefix filter: an overlap of ``need`` words leaves at least one common word among
  the first ``size - need + 1`` words on either side, so only those are joined;
* length filter: the block has ``need`` words at least;
* positional filter: what stands after the two positions can still reach ``need``;
* each (block, template) is verified once, at its first common word.

A window that begins with a word outside the template holds no more of it than the one
that begins at the next word inside, so windows that begin inside are the blocks, and
those that can't meet the template by their number of words are dropped at once.

The filters only drop pairs that can't meet the threshold: the join is exact.

Beside it stand the base places: where the words of a phrase stand consecutively.

Defined cases: null text is empty (no words, no places, score 0); an empty table
gives an empty result; rows that repeat a doc_id are scanned one by one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from insights.llm.columns import ascii_lower, whole_text
from insights.plans.sinks import materialize

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}



class Notice(NamedTuple):
    label: str
    text: str
    needed: tuple[str, ...] = ()
    barred: tuple[str, ...] = ()


# Sentences of common license notices: label, words, words it needs, words that rule it out.
TEMPLATES = (
    Notice("mit", "released under the mit license", ("mit", "license")),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"
                  " and associated documentation files", ("permission", "granted", "software")),
    Notice("mit", "the above copyright notice and this permission notice shall be included in all copies or"
                  " substantial portions of the software", ("permission", "notice", "copies", "substantial")),
    Notice("apache", "licensed under the apache license version 2 0", ("apache", "license")),
    Notice("gpl", "this work is licensed under the gnu general public license version 3", ("general", "public", "license")),
    Notice("gpl", "this program is free software you can redistribute it and or modify it under the terms of the"
                  " gnu general public license as published by the free software foundation",
           ("general", "public", "license")),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", ("cc", "by", "nc")),
    Notice("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
           ("creative", "commons", "attribution", "noncommercial")),
    Notice("cc-by", "licensed under cc by 4 0", ("cc", "by"), ("nc", "sa", "nd")),
    Notice("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
           ("creative", "commons", "attribution"), ("noncommercial", "sharealike", "noderivatives")),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted"
                  " provided that the following conditions are met", ("redistribution", "permitted")),
    Notice("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or"
                  " promote products derived from this software without specific prior written permission",
           ("neither", "contributors", "endorse", "permission")),
    Notice("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
           ("mozilla", "public", "license")),
    Notice("reserved", "all rights reserved", ("all", "rights", "reserved")),
)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _places(phrases: Sequence[str]) -> str:
    return rf"(?<!{WORD})(?:" + "|".join(GAP.join(p.split()) for p in phrases) + rf")(?!{WORD})"


def _need(template: str, threshold: float) -> int:
    return math.ceil(threshold * len(set(template.split())) - 1e-9)


def _literals(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _words(c: Column) -> Column:
    return F.size(F.array_remove(F.split(c, GAP), "")).cast("long")


def _holds(words: Column, notice: Notice, threshold: float) -> Column:
    """Whether ``words`` hold enough of the notice, and all that it needs."""
    inside = _literals(sorted(set(notice.text.split())))
    return reduce(and_, [F.array_contains(words, w) for w in notice.needed],
                  F.size(F.array_intersect(words, inside)) >= _need(notice.text, threshold))


def _windows(notice: Notice, number: int, vocabulary: Sequence[str], threshold: float) -> Column:
    """The windows of a template over ``words`` that hold enough of it, what it needs and nothing that rules it out."""
    inside, long, words = _literals(sorted(set(notice.text.split()))), len(notice.text.split()), F.col("words")

    def held(p: Column) -> Column:
        return F.slice(words, p, long)

    def fits(p: Column) -> Column:
        return reduce(and_, [~F.array_contains(held(p), w) for w in notice.barred],
                      F.array_contains(inside, F.get(words, p - 1)) & _holds(held(p), notice, threshold))

    starts = F.filter(F.sequence(F.lit(1), F.size(words)), fits)
    return F.transform(starts, lambda p: F.struct(
        (p - 1).alias("first"), F.least(p + (long - 2), F.size(words) - 1).alias("last"), F.lit(number).alias("of"),
        F.array_intersect(held(p), _literals(vocabulary)).alias("words")))


def _vocabulary(templates: Sequence[Notice]) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()})


def scanned(docs: DataFrame, phrases: Mapping[str, str], templates, threshold: float) -> DataFrame:
    """One row per document: base places, its template words (``known``), and its blocks (first and
    last word, number of the template, template words) where the whole text holds enough of a template;
    elsewhere no block can."""
    vocabulary = _vocabulary(templates)
    low = docs.select(docs["doc_id"].alias("doc_id"), ascii_lower(whole_text(docs)).alias("low"))
    low = low.withColumn("words", F.array_remove(F.split("low", GAP), ""))
    any_place, low_text = _places(list(phrases)), F.col("low")
    # every place of a phrase holds its longest word as written
    maybe = reduce(or_, [low_text.contains(w) for w in {max(p.split(), key=len) for p in phrases}])
    counted = low.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "low", "words", F.size("words").cast("long").alias("n_words"),
        F.array_intersect("words", _literals(vocabulary)).alias("known"),
        F.when(maybe, F.regexp_count(low_text, F.lit(any_place))).otherwise(0).cast("long").alias("n_base"))
    found = F.col("n_base") > 0
    before_first = F.regexp_extract(low_text, f"(?s)^(.*?){any_place}", 1)
    before_last = F.regexp_extract(low_text, f"(?s)^(.*){any_place}", 1)
    labels = F.array_compact(F.array(*[F.when(low_text.rlike(_places([p])), F.lit(label))
                                       for p, label in phrases.items()]))
    none, nothing = F.array().cast("array<string>"), F.array().cast("array<struct<first:int,last:int,of:int,words:array<string>>>")
    blocks = [F.when(_holds(F.col("known"), t, threshold), _windows(t, k, vocabulary, threshold)).otherwise(nothing)
              for k, t in enumerate(templates)]
    return counted.select(
        "row", "doc_id", "n_words", "n_base",
        F.when(found, _words(before_first)).alias("first_word"),
        F.when(found, _words(before_last)).alias("last_word"),
        F.when(found, F.array_sort(F.array_distinct(labels))).otherwise(none).alias("base"), "known",
        F.concat(*blocks).alias("blocks"))


def _template_rows(spark: SparkSession, templates, order: Sequence[str], threshold: float) -> DataFrame:
    """A row per word of each template's prefix; as many as the fixed templates have words."""
    at = {w: i for i, w in enumerate(order)}
    rows = []
    for k, (label, text, _, _) in enumerate(templates):
        words = sorted(set(text.split()), key=at.__getitem__)
        need = _need(text, threshold)
        for i, w in enumerate(words[: len(words) - need + 1]):
            rows.append(F.struct(F.lit(w).alias("word"), F.lit(i).alias("i"), F.lit(k).alias("template"),
                                 F.lit(label).alias("label"), F.lit(need).alias("need"),
                                 _literals(words).alias("whole")))
    return spark.range(1).select(F.inline(F.array(*rows)))


def join_templates(blocks: DataFrame, order: Sequence[str], templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """(row, block, template, label, containment) of every block that meets a template.

    ``blocks``: row, block (what tells it from the text's others), words (distinct, of the vocabulary);
    ``order``: the vocabulary, rarest word first."""
    least = min(_need(t.text, threshold) for t in templates)
    ordered = blocks.filter(F.size("words") >= least).withColumn(
        "words", F.array_intersect(_literals(order), "words"))
    prefix = ordered.select("row", "block", "words", F.posexplode(
        F.slice("words", F.lit(1), F.size("words") - least + 1)).alias("j", "word"))
    of = F.broadcast(_template_rows(blocks.sparkSession, templates, order, threshold))
    size, common = F.size("words"), F.array_intersect("words", "whole")
    return (prefix.join(of, "word")
            .filter((size >= F.col("need")) & (F.col("j") <= size - F.col("need"))
                    & (F.least(F.size("whole") - F.col("i"), size - F.col("j")) >= F.col("need")))
            .withColumn("common", common)
            .filter((F.size("common") >= F.col("need")) & (F.col("common")[0] == F.col("word")))
            .select("row", "block", "template", "label", (F.size("common") / F.size("whole")).alias("containment")))


def _notices() -> Column:
    """How many notices ``windows`` are: of one template, those that begin where one counted before still
    reaches are one notice."""
    start = F.struct(F.lit(-1).alias("template"), F.lit(-1).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(F.array_sort("windows"), start, lambda a, w: F.when(
        (a["template"] == w["template"]) & (w["first"] <= a["end"]), a).otherwise(F.struct(
            w["template"].alias("template"), w["last"].alias("end"), (a["n"] + 1).alias("n"))), lambda a: a["n"])


def scan(docs: DataFrame, templates=TEMPLATES, phrases: Mapping[str, str] = PHRASES,
         threshold: float = 0.8) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks
    (notices found: windows of a template that overlap are one)."""
    texts = materialize(scanned(docs, phrases, templates, threshold), "blocks")
    counts = texts.select(F.explode("known").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    seen = {r["word"]: r["n"] for r in counts.collect()}  # as many rows as the fixed vocabulary has words
    order = sorted(_vocabulary(templates), key=lambda w: (seen.get(w, 0), w))
    blocks = texts.select("row", F.explode("blocks").alias("of")).select(
        "row", F.struct("of.first", "of.last", F.col("of.of").alias("of")).alias("block"), "of.words")
    met = (join_templates(blocks, order, templates, threshold)
           .filter(F.col("block.of") == F.col("template")).groupBy("row")
           .agg(F.collect_set("label").alias("met"), F.max("containment").alias("most"),
                F.collect_set(F.struct("template", "block.first", "block.last")).alias("windows"))
           .select("row", "met", "most", _notices().alias("n_blocks")))
    none = F.array().cast("array<string>")
    return texts.drop("blocks", "known").join(met, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("met", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"))
