"""Licence statements in texts: exact phrases, and a set-similarity join with templates.

A block is a stretch of consecutive words, wherever lines end: for a template of n words, every stretch
of BLOCK * n words. A text contains a template when one of its blocks holds at least THRESHOLD of
the template's distinct words. Words are ordered by how many documents hold them, rarest first. A block
that contains a template must share one of the template's first words in that order (prefix filter).
Around every such word, the words that any block with it can hold must be enough (length filter), and
must still be able to reach the needed overlap from the place where the two meet (positional filter).
Only the blocks of places that pass are counted in full.

Frequencies are needed for the words of the templates alone: no other word can be shared.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.llm.common import ascii_lower, durable, text_or_empty

THRESHOLD = 0.8
BLOCK = 2  # words of a block for each word of its template, so that other words may stand between
MOST_TEMPLATES = 1000  # the template side is broadcast; more than this is refused

# Phrases and the labels they give
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# One statement for each label of the join, in the usual words of these licences
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, "
           "are permitted",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc0": "To the extent possible under law, the author has waived all copyright",
    "gpl-3": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mpl-2.0": "This file is subject to the terms of the Mozilla Public License, version 2.0",
    "proprietary": "Copyright. All rights reserved. No part may be reproduced without permission",
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _starts(phrase: str) -> str:
    """SQL: word `i` of `words` starts the phrase."""
    return "(" + " and ".join(
        f"get(words, i + {k}) = '{word}'" for k, word in enumerate(phrase.split())) + ")"


def read_texts(docs: DataFrame, phrases: dict[str, str], known: list[str]) -> DataFrame:
    """One pass over the texts: doc_id, text_key, word count, places of phrases, known words held.

    places has a (start, label) for every place of a phrase; the phrase's words are looked for
    only in texts that hold them somewhere.
    """
    may = " or ".join(
        "(" + " and ".join(f"contains(low, '{w}')" for w in p.split()) + ")" for p in phrases)
    cases = " ".join(f"when {_starts(p)} then '{label}'" for p, label in phrases.items())
    return (
        docs.select("doc_id", ascii_lower(text_or_empty()).alias("low"))
        .withColumn("words", words(F.col("low")))
        .select("doc_id", F.xxhash64("low").alias("text_key"),
                F.size("words").cast("long").alias("n_words"),
                F.array_intersect(F.array(*map(F.lit, known)), "words").alias("held"),
                F.expr(f"""case when size(words) > 0 and ({may}) then filter(
                  transform(sequence(0, size(words) - 1),
                            i -> struct(i as start, case {cases} end as label)),
                  p -> p.label is not null)
                else array() end""").alias("places"))
    )


def template_words(spark: SparkSession, templates: dict[str, str]) -> dict[str, list[str]]:
    """The words of every template, repeats included."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"at most {MOST_TEMPLATES} templates, which are broadcast")
    rows = spark.createDataFrame(list(templates.items()), "label string, text string").select(
        "label", words(ascii_lower(F.col("text"))).alias("words")).collect()
    if any(not row.words for row in rows):
        raise ValueError("a template without words would be contained in every block")
    return {row.label: row.words for row in rows}


def prefix_index(read: DataFrame, texts: dict[str, list[str]], threshold: float) -> tuple[list[str], list]:
    """The templates' words, rarest first, and rows (word, label, place, size, need, span, template).

    span is the number of words of a block. What comes to the driver is one document count for each
    template word.
    """
    found = dict(read.select(F.explode("held").alias("word")).groupBy("word").count().collect())
    order = sorted(set().union(*texts.values()), key=lambda w: (found.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    index = []
    for label, text in sorted(texts.items()):
        ranked = sorted(set(text), key=place.get)
        need = math.ceil(threshold * len(ranked) - 1e-9)
        index += [
            (w, label, i, len(ranked), need, BLOCK * len(text), ranked)
            for i, w in enumerate(ranked[: len(ranked) - need + 1])]
    return order, index


def contained_templates(docs: DataFrame, order: list[str], index: list) -> DataFrame:
    """doc_id, text_key, label, containment: the best block of every text and template it contains."""
    prefixes = docs.sparkSession.createDataFrame(
        index, "word string, label string, i int, size int, need int, span int, template array<string>")
    first = sorted({entry[0] for entry in index})
    widest = max((entry[5] for entry in index), default=1)
    # bound to one variable, so that lower-casing isn't repeated for every word
    somewhere = F.exists(F.array("low"), lambda low: functools.reduce(
        operator.or_, (F.contains(low, F.lit(w)) for w in first), F.lit(False)))
    read = (
        docs.select("doc_id", ascii_lower(text_or_empty()).alias("low")).where(somewhere)
        .select("doc_id", F.xxhash64("low").alias("text_key"), words(F.col("low")).alias("words"))
    )
    # each meeting goes on with the words around it only, not with its text
    hits = F.transform(
        F.filter(F.transform("words", lambda w, at: F.struct(at.alias("at"), w.alias("word"))),
                 lambda h: h["word"].isin(first)),
        lambda h: F.struct(
            h["word"].alias("word"), F.least(h["at"], F.lit(widest - 1)).alias("before"),
            F.slice("words", F.greatest(h["at"] - widest + 2, F.lit(1)), F.lit(2 * widest - 1)).alias("around")))
    met = (
        read.select("doc_id", "text_key", F.explode(hits).alias("hit")).select("doc_id", "text_key", "hit.*")
        .join(F.broadcast(prefixes), "word")
        .withColumn("low", F.greatest(F.col("before") - F.col("span") + 1, F.lit(0)))
        .withColumn("held", F.array_intersect(
            F.array(*map(F.lit, order)),
            F.slice("around", F.col("low") + 1, F.col("before") - F.col("low") + F.col("span"))))
        .withColumn("n", F.size("held")).withColumn("j", F.expr("array_position(held, word) - 1"))
        .where("n >= need and 1 + least(i, j) + least(size - i - 1, n - j - 1) >= need")
    )
    overlap = F.array_max(F.transform(
        F.sequence("low", "before"),
        lambda start: F.size(F.array_intersect("template", F.slice("around", start + 1, F.col("span"))))))
    return (
        met.withColumn("overlap", overlap).where("overlap >= need")
        .groupBy("doc_id", "text_key", "label")
        .agg(F.max(F.col("overlap") / F.col("size")).alias("containment"))
    )


def scan_licences(docs: DataFrame, phrases: dict[str, str] = PHRASES,
                  templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: word and phrase counts, labels of phrases and templates, a score.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score. The score
    is 1 if a phrase is there, else the largest containment found, else 0. Null texts count as
    empty: no words, no labels, score 0. Ids may be null or repeated: results belong to the row's
    own text. Other columns of docs are not read; an empty table gives an empty result.
    """
    sets = template_words(docs.sparkSession, templates)
    read = durable(read_texts(docs, phrases, sorted(set().union(*sets.values()))))
    by_text = (
        contained_templates(docs, *prefix_index(read, sets, threshold))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("label").alias("own"), F.max("containment").alias("containment"))
        .withColumnRenamed("doc_id", "own_id").withColumnRenamed("text_key", "own_key")
    )
    base = read.select(
        "doc_id", "text_key", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").cast("long").alias("first_word"),
        F.array_max("places.start").cast("long").alias("last_word"),
        F.array_distinct("places.label").alias("base"),
    )
    none = F.array().cast("array<string>")
    return base.join(
        by_text, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")),
        "left",
    ).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("own", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
