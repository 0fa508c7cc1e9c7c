"""License texts: phrases, and an exact containment join of text blocks with templates.

Only DataFrame and SQL functions.  Blocks are windows of words, each half over the last.  A template's distinct words are
put in the order of how many documents of the whole corpus hold them, the rarest first, and so are a block's words
that any template has.  If a block holds at least a share t of a template's n words, it holds one of the
template's first n - ceil(t * n) + 1 words (prefix filter), has ceil(t * n) such words itself (length filter), and
behind the rarest word they share enough words are left on both sides (positional filter): in the template and
in the block.  What passes is counted exactly.

Templates are a short list given by the caller; their word table (one row for each prefix word of a
template) is broadcast.  Texts without a prefix word never leave their row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.llm.common import lower_az, table
from riffle.llm.registry import query

#: Phrases of the base count and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Well-known notices as the licenses themselves word them.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc", "This work is licensed under the Creative Commons Attribution license"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
]
CONTAINMENT = 0.8
BLOCK_WORDS = 64


def words_text(text: Column) -> Column:
    """The words, A-Z lower-cased, each between single blanks, a blank at both ends; one blank if there is none."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lower_az(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), F.lit(" "))


def _count(text: Column, phrase: str) -> Column:
    """Places of a phrase; the blank behind one may stand before the next."""
    return F.when(F.instr(text, f" {phrase} ") > 0, F.regexp_count(text, F.lit(f" {phrase}(?= )"))).otherwise(0)


def phrase_counts(docs: DataFrame, words: str, phrases: dict[str, str]) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word and base_labels of the words in column ``words``."""
    w = F.col(words)
    blanks = lambda s: F.length(s) - F.length(F.translate(s, " ", ""))
    places = {p: _count(w, p) for p in phrases}
    first = {p: F.when(F.instr(w, f" {p} ") > 0, blanks(F.substring_index(w, f" {p} ", 1))) for p in phrases}
    last = {p: F.when(F.instr(w, f" {p} ") > 0, blanks(w) - 1 - len(p.split()) - blanks(F.substring_index(w, f" {p} ", -1))) for p in phrases}
    none = F.lit(None).cast("long")
    labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(F.instr(w, f" {p} ") > 0, F.lit(x)) for p, x in phrases.items())))))
    return docs.withColumns({
        "n_words": F.when(w == "  ", 0).otherwise(blanks(w) - 1).cast("long"),
        "n_base": reduce(lambda a, b: a + b, places.values()).cast("long"),
        "first_word": F.least(*first.values(), none).cast("long"),
        "last_word": F.greatest(*last.values(), none).cast("long"),
        "base_labels": F.concat_ws(",", labels),
    })


def word_blocks(words: Column, size: int = BLOCK_WORDS) -> Column:
    """Windows of ``size`` words, each half over the last; every run of size / 2 words lies within one."""
    step = size // 2
    found = F.split(F.trim(words), " ")
    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(found) - 1) / step).cast("int") - 1)), lambda i: F.slice(found, i * step + 1, size))


def template_words(docs: DataFrame, templates: list[tuple[str, str]]) -> tuple[list[list[str]], list[str]]:
    """Distinct words of each template, and of all, in the order of how many of the texts in column ``_words`` hold them; ties by name.

    The counts cover the whole corpus; only the templates' own words, a short list, come to the driver.
    """
    rows = docs.sparkSession.createDataFrame([(i, t) for i, (_, t) in enumerate(templates)], "template int, text string")
    own = {r.template: set(r.words) - {""} for r in rows.select("template", F.split(F.trim(words_text(F.col("text"))), " ").alias("words")).collect()}
    vocabulary = sorted(set().union(*own.values()))
    if not vocabulary:
        return [[] for _ in templates], []
    held = F.array_intersect(F.split(F.trim("_words"), " "), F.array(*map(F.lit, vocabulary)))
    often = {r.word: r.n for r in docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(vocabulary, key=lambda w: (often.get(w, 0), w))
    return [[w for w in order if w in own[i]] for i in range(len(templates))], order


def containment(docs: DataFrame, templates: list[tuple[str, str]], share: float = CONTAINMENT, size: int = BLOCK_WORDS) -> DataFrame:
    """(key, template, similarity) of all blocks of docs (key, _words) that hold at least ``share`` of a template's words.

    Exact: the filters never lose a pair.  Words are compared as sets.  A template without words matches nothing.
    """
    pairs = candidate_pairs(docs, templates, share, size)
    common = F.size(F.array_intersect("tokens", "held"))
    return pairs.where(common >= F.col("need")).select("key", "template", (common / F.size("tokens")).alias("similarity"))


def candidate_pairs(docs: DataFrame, templates: list[tuple[str, str]], share: float, size: int, positional: bool = True) -> DataFrame:
    """(key, held, template, tokens, need) of the pairs of a block and a template that pass the filters, each once.

    held are the block's words that any template has, tokens the template's, both in the global order.
    """
    spark = docs.sparkSession
    tokens, order = template_words(docs, templates)
    rows = []
    for i, t in enumerate(tokens):
        need = math.ceil(share * len(t) - 1e-9)
        rows += [(i, t, need, place, w) for place, w in enumerate(t[: len(t) - need + 1])]
    index = spark.createDataFrame(rows, "template int, tokens array<string>, need int, place int, word string")
    prefix = sorted({r[4] for r in rows})
    if not prefix:
        none = F.array().cast("array<string>")
        return docs.select("key", none.alias("held"), F.lit(0).alias("template"), none.alias("tokens"), F.lit(0).alias("need")).limit(0)
    marks, every = F.array(*map(F.lit, prefix)), F.array(*map(F.lit, order))
    likely = docs.where(F.arrays_overlap(F.split(F.trim("_words"), " "), marks))
    blocks = likely.select("key", F.explode(word_blocks(F.col("_words"), size)).alias("words"))
    ordered = blocks.select("key", F.array_intersect(every, F.col("words")).alias("held"))
    probes = ordered.select("key", "held", F.explode(F.array_intersect("held", marks)).alias("word"))
    pairs = probes.join(F.broadcast(index), "word").where(F.size("held") >= F.col("need"))
    if positional:
        at = F.array_position("held", F.col("word")) - 1
        pairs = pairs.where(F.least(F.size("tokens") - F.col("place"), F.size("held") - at) >= F.col("need"))
    first = F.get(F.filter("tokens", lambda t: F.array_contains("held", t)), F.lit(0)) == F.col("word")  # a pair comes up by its rarest word only
    return pairs.where(first).select("key", "held", "template", "tokens", "need")


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None, share: float = CONTAINMENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of ``docs``.

    labels are those of the phrases and of the templates found; score is the largest containment of a template in a
    block, 1 where a phrase stands, 0 without either.  Null and empty texts have 0 words.  Rows with equal ids and texts
    get equal results, each its own row; other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    docs = docs.select(F.col(doc_id).alias("doc_id"), words_text(F.col(text)).alias("_words"))
    base = phrase_counts(docs, "_words", phrases).withColumn("key", F.xxhash64("_words"))
    found = _template_labels(docs, templates, share)
    labels = F.array_sort(F.array_distinct(F.concat(F.filter(F.split("base_labels", ","), lambda x: x != ""), F.coalesce("found", F.array().cast("array<string>")))))
    return base.join(found, "key", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", F.concat_ws(",", labels).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def _template_labels(docs: DataFrame, templates: list[tuple[str, str]], share: float) -> DataFrame:
    """(key, found, best) of the word sequences, by their hash, with a block that contains a template."""
    longest = max((len(t.split()) for _, t in templates), default=0)
    hits = containment(docs.select(F.xxhash64("_words").alias("key"), "_words"), templates, share, 2 * max(BLOCK_WORDS // 2, longest))
    names = F.array(*(F.lit(label) for label, _ in templates)) if templates else F.array().cast("array<string>")
    return hits.groupBy("key").agg(F.collect_set(F.get(names, F.col("template"))).alias("found"), F.max("similarity").alias("best"))


@query("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every whole document."""
    return scan(table(spark, sf_dir, "documents"))
