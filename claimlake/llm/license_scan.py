"""License scans: phrases, and an exact set-similarity join with license templates.

A block is a line of a document, or a window of as many words as the template
has, wherever lines end; a template is a license sentence.  All are sets of
words.  All blocks are found whose share of a template's words reaches the
threshold.  Words are put in one global order, rarest first by the number of
documents that hold them.  A block that holds at least o of a template's m
words shares a word with the first m - o + 1 of them (prefix filter), which
is also among the first |b| - o + 1 template words of the block; it has at
least o words of the template vocabulary (length filter), and what can still
follow the shared word in both reaches o (positional filter).  Words outside
all templates can never be shared; they are left out before anything moves.
A window that reaches o holds a prefix word too, so windows are laid only over
the neighbourhoods of prefix words that have o words of the template.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm import common

THRESHOLD = 0.8
BLOCK = r"\n"
MAX_TEMPLATE_WORDS = 20_000  # the template table is a parameter of this size at most; it is part of the plan

# Phrases with their labels, as words.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Sentences of public licenses and usual notices, with the method's labels.
TEMPLATES = {
    "gpl-3.0": ["this work is licensed under the gnu general public license version 3",
                "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl-2.0": ["this work is licensed under the gnu general public license version 2"],
    "lgpl": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"],
    "apache-2.0": ["licensed under the apache license version 2 0",
                   "you may not use this file except in compliance with the license"],
    "cc-by-nc-4.0": ["licensed under cc by nc 4 0"],
    "cc-by-sa-4.0": ["licensed under cc by sa 4 0"],
    "cc-by-4.0": ["this work is licensed under a creative commons attribution 4 0 international license"],
    "mit-notice": ["released under the mit license",
                   "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "no-warranty": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
}


def normal(text: Column) -> Column:
    """Words (a-z after lower-casing A-Z, 0-9, all beyond ASCII) with one blank between them; null: empty."""
    low = common.ascii_lower(F.coalesce(text, F.lit("")))
    return F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _words(norm: Column) -> Column:
    return F.filter(F.split(norm, " ", -1), lambda w: w != "")


def template_order(docs: DataFrame, vocabulary: list[str], norm: str = "__norm") -> dict[str, int]:
    """Place of each template word in the global order: by the number of documents with it, then the word.
    The driver gets one count per template word."""
    seen = (docs.select(F.explode(F.array_intersect(F.split(norm, " "), F.array(*map(F.lit, vocabulary)))).alias("w"))
            .groupBy("w").count())
    count = {r["w"]: r["count"] for r in seen.collect()}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (count.get(w, 0), w)))}


def _prefixes(docs: DataFrame, templates: dict[str, list[str]], threshold: float, text: str) -> tuple[DataFrame, list[str], list[tuple]]:
    """One row per (template, prefix word); the vocabulary in the global order; the same rows."""
    sets = [(label, sorted(set(t.split())), len(t.split())) for label, texts in templates.items() for t in texts]
    vocabulary = sorted({w for _, ws, _ in sets for w in ws})
    if not sets or any(not ws for _, ws, _ in sets) or len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError("templates need words, and at most MAX_TEMPLATE_WORDS of them")
    place = template_order(docs.select(normal(F.col(text)).alias("__norm")), vocabulary)
    rows = []
    for i, (label, ws, span) in enumerate(sets):
        ordered, o = sorted(ws, key=place.get), math.ceil(threshold * len(ws) - 1e-9)
        for j, w in enumerate(ordered[:len(ws) - o + 1]):
            rows.append((i, label, w, j, len(ws), o, span, ordered))
    prefixes = docs.sparkSession.createDataFrame(rows, "t int, label string, w string, j int, m int, o int, span int, words array<string>")
    return prefixes, sorted(vocabulary, key=place.get), rows


def _with_prefix_word(docs: DataFrame, rows: list[tuple], text: str, key: str) -> DataFrame:
    first = sorted({r[2] for r in rows})
    return (docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
            .filter(F.arrays_overlap(F.split(normal(F.col("__text")), " "), F.array(*map(F.lit, first)))))


def _lines(docs: DataFrame, found: tuple, block: str, text: str, key: str) -> DataFrame:
    prefixes, order, rows = found
    least = min(r[5] for r in rows)
    by_place = F.array(*map(F.lit, order))
    held = (_with_prefix_word(docs, rows, text, key)
            .select("__key", F.posexplode(F.split("__text", block)).alias("block", "__line"))
            # template words of the block in the global order
            .select("__key", "block", F.array_intersect(by_place, F.split(normal(F.col("__line")), " ")).alias("__set"))
            .filter(F.size("__set") >= least))
    shared = (held.select("*", F.posexplode("__set").alias("__i", "w")).join(F.broadcast(prefixes), "w")
              .filter((F.size("__set") >= F.col("o")) & (F.col("__i") <= F.size("__set") - F.col("o"))
                      & (1 + F.least(F.size("__set") - F.col("__i") - 1, F.col("m") - F.col("j") - 1) >= F.col("o")))
              .dropDuplicates(["__key", "block", "t"]))
    got = shared.withColumn("__n", F.size(F.array_intersect("__set", "words"))).filter(F.col("__n") >= F.col("o"))
    return got.select(F.col("__key").alias(key), "block", "label", (F.col("__n") / F.col("m")).alias("containment"))


def _windows(docs: DataFrame, found: tuple, text: str, key: str) -> DataFrame:
    prefixes, _, rows = found
    first = F.array(*map(F.lit, sorted({r[2] for r in rows})))
    reach = max(r[6] for r in rows) - 1
    # around each prefix word of a text, the words that can share a window with it; "" beyond the text's ends
    edge = F.array_repeat(F.lit(""), reach)
    padded = _with_prefix_word(docs, rows, text, key).select("__key", F.concat(edge, _words(normal(F.col("__text"))), edge).alias("__words"))
    near = F.transform(F.filter(F.transform("__words", lambda w, i: F.when(F.array_contains(first, w), i)), lambda i: i.isNotNull()),
                       lambda i: F.struct((i - reach).alias("place"), F.slice("__words", i - reach + 1, 2 * reach + 1).alias("around")))
    hits = (padded.select("__key", F.explode(near).alias("__near")).select("__key", "__near.place", "__near.around")
            .withColumn("w", F.element_at("around", reach + 1)).join(F.broadcast(prefixes), "w")
            .withColumn("around", F.slice("around", reach + 2 - F.col("span"), 2 * F.col("span") - 1))
            .filter(F.size(F.array_intersect("around", "words")) >= F.col("o")))
    most = F.array_max(F.transform(F.sequence(F.lit(1), F.col("span")),
                                   lambda s: F.size(F.array_intersect(F.slice("around", s, F.col("span")), F.col("words")))))
    got = hits.withColumn("__n", most).filter(F.col("__n") >= F.col("o"))
    return got.select(F.col("__key").alias(key), "place", "label", (F.col("__n") / F.col("m")).alias("containment"))


def similar_blocks(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD,
                   block: str = BLOCK, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, block, label, containment) of every line that reaches the threshold for a template.

    ``block`` counts the pieces between matches of the pattern from 0.  Null
    and empty texts have no block; a block holds a word once however often it
    repeats; a template without words is refused.
    """
    return _lines(docs, _prefixes(docs, templates, threshold, text), block, text, key)


def similar_windows(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD,
                    text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, place, label, containment): of each prefix word (``place`` in the text's words, from 0) the best window
    with it, of as many words as the template has and across line breaks, where it reaches the threshold."""
    return _windows(docs, _prefixes(docs, templates, threshold, text), text, key)


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): words, phrase places and labels.

    Null and empty texts: no words, no labels, score 0.  Rows that repeat a
    doc_id are told apart by their text; equal rows get equal results.  Columns
    beside doc_id and text are not used.
    ``score``: 1 where a phrase stands, else the best containment found in a line or a window, else 0.
    """
    pattern = " (?:" + "|".join(phrases) + ")(?= )"
    base = (docs.select("doc_id", "text").withColumn("__id", F.struct("doc_id", F.xxhash64("text")).cast("struct<a:bigint,b:bigint>"))
            .withColumn("__id", F.concat_ws("/", F.col("__id.a").cast("string"), F.col("__id.b").cast("string"), F.col("doc_id").isNull().cast("string"))))
    prefixes = _prefixes(base, templates, threshold, "text")
    similar = _lines(base, prefixes, BLOCK, "text", "__id").drop("block").unionByName(_windows(base, prefixes, "text", "__id").drop("place"))
    found = (similar.groupBy("__id")
             .agg(F.collect_set("label").alias("__labels"), F.max("containment").alias("__best")).withColumnRenamed("__id", "__found"))
    n_words = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    rows = base.select("doc_id", "__id", normal(F.col("text")).alias("__norm"))
    rows = rows.select("doc_id", "__id", "__norm", F.concat(F.lit(" "), "__norm", F.lit(" ")).alias("__padded"))
    rows = rows.select("doc_id", "__id", F.when(F.col("__norm") == "", 0).otherwise(n_words(F.col("__norm")) + 1).cast("bigint").alias("n_words"),
                       F.regexp_extract_all("__padded", F.lit("(" + pattern + ")"), F.lit(1)).alias("__places"),
                       F.when(F.col("__padded").rlike(pattern), F.split("__padded", pattern)).alias("__pieces"))
    label = F.array(*[F.when(F.array_contains("__places", " " + p), F.lit(v)) for p, v in phrases.items()])
    rows = rows.select(
        "doc_id", "__id", "n_words", F.size("__places").cast("bigint").alias("n_base"),
        n_words(F.element_at("__pieces", 1)).cast("bigint").alias("first_word"),
        (F.col("n_words") - n_words(F.rtrim(F.element_at("__pieces", -1))) - n_words(F.element_at(F.when(F.size("__places") > 0, F.col("__places")), -1))).cast("bigint").alias("last_word"),
        F.array_compact(label).alias("__base"))
    rows = rows.join(found, F.col("__id") == F.col("__found"), "left")
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("__base")).alias("base_labels"),
                       joined(F.concat("__base", F.coalesce("__labels", F.array().cast("array<string>")))).alias("labels"),
                       F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("__best", F.lit(0.0))).alias("score"))


def _oracle() -> str:
    lines = []
    for name, texts in TEMPLATES.items():
        for t in texts:
            ws = sorted(set(t.split()))
            lines.append(f"('{name}', [{', '.join(repr(w) for w in ws)}], {math.ceil(THRESHOLD * len(ws) - 1e-9)})")
    base = ", ".join(f"(string_split('{p}', ' '), '{v}')" for p, v in PHRASES.items())
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH tpl(label, words, o) AS (VALUES {', '.join(lines)}),
phr(p, label) AS (VALUES {base}),
d AS (SELECT row_number() OVER () AS r, doc_id, {low} AS low FROM documents),
w AS (SELECT r, doc_id, low, {words.format('low')} AS ws FROM d),
c AS (SELECT r, ws FROM w WHERE low LIKE '%license%' OR low LIKE '%cc%'),
place AS (SELECT r, ws, unnest(range(len(ws))) AS i FROM c),
b AS (SELECT r, i, phr.label FROM place JOIN phr ON place.ws[i + 1 : i + len(phr.p)] = phr.p),
bs AS (SELECT r, count(*) AS n, min(i) AS f, max(i) AS l, list_distinct(list(label)) AS labels FROM b GROUP BY r),
blocks AS (SELECT r, {words.format('line')} AS bw FROM (SELECT r, unnest(string_split(low, chr(10))) AS line FROM d)),
m AS (SELECT r, tpl.label, len(list_intersect(bw, tpl.words))::DOUBLE / len(tpl.words) AS s FROM blocks, tpl
  WHERE len(bw) >= o AND len(list_intersect(bw, tpl.words)) >= o),
ms AS (SELECT r, list_distinct(list(label)) AS labels, max(s) AS s FROM m GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, f::BIGINT AS first_word, l::BIGINT AS last_word,
  array_to_string(list_sort(coalesce(bs.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(bs.labels, []), coalesce(ms.labels, [])))), ',') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(ms.s, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN bs USING (r) LEFT JOIN ms USING (r)
"""


ORACLE = _oracle()
