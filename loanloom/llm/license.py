"""License scans: exact containment of license templates in text blocks, in SQL alone.

A template is a set of words. A block contains it when it holds at least ``percent`` of them.
Blocks are overlapping windows of a text's words, however they are wrapped over lines; the words
must stand within the template's length, as much longer as ``percent`` leaves room for. The set-similarity join runs over words in global order, rarest first,
counted over the whole corpus:

* prefix: a block that contains a template of n words holds one of its first
  n - ceil(percent n) + 1 words, so only blocks with such a word become candidates;
* length: the block needs ceil(percent n) of the words that occur in templates at all;
* position: the first common word at place i of the template and j of the block leaves
  1 + min(n - i - 1, size - j - 1) words to share, which must be enough.

Candidates are then counted exactly. The template table is fixed, so its size is bounded.
Beside it, phrases are found wherever their words stand one after the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERCENT = 90

#: Phrases of consecutive words and the labels they give; fixed by the contract.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices that stand in texts; the label each one gives.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
    "on an as is basis without warranties or conditions of any kind either express or implied": "apache",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose": "gpl",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software": "mit",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "bsd",
    "if a copy of the mpl was not distributed with this file you can obtain one at": "mpl",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
    "all rights reserved no part of this publication may be reproduced": "all-rights-reserved",
}

#: Words are runs of these after A-Z are lower-cased; fixed by the contract, which names what is
#: left out, up to 2F, from 3A to 60 and from 7B to 7F. The pattern engine is ten times as fast on what is left in.
WORD = r"[0-9a-z\\x80-\\x{10FFFF}]++"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


def words(text: str) -> str:
    return f"regexp_extract_all({text}, '{WORD}', 0)"


def quoted(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def _any_of(values: Sequence[str]) -> str:
    """A pattern for any of the words (letters, digits and hyphens only)."""
    return "(" + "|".join(sorted(set(values))) + ")"


def word_order(documents: DataFrame, templates: dict[str, str] = TEMPLATES) -> list[str]:
    """The words of all templates, rarest in the corpus first, ties by the word.

    Counts documents that hold the word, over whole texts; the result has one row per
    word of the fixed template table.
    """
    vocabulary = sorted({w for t in templates for w in t.split()})
    held = f"array_intersect({words(lowered('text'))}, array({quoted(vocabulary)}))"
    counts = documents.select(F.explode(F.expr(held)).alias("word")).groupBy("word").count()
    seen = {r.word: r["count"] for r in counts.collect()}
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def template_rows(order: Sequence[str], templates: dict[str, str], percent: int) -> list[tuple]:
    """(template, label, words in order, least overlap, prefix length, words it may span)."""
    place = {w: i for i, w in enumerate(order)}
    out = []
    for text, label in templates.items():
        held = sorted(set(text.split()), key=place.__getitem__)
        least = -(-len(held) * percent // 100)
        span = -(-len(text.split()) * 100 // percent)
        out.append((text, label, held, least, len(held) - least + 1, span))
    return out


def license_blocks(
    documents: DataFrame, templates: dict[str, str] = TEMPLATES, percent: int = PERCENT, order: Sequence[str] | None = None
) -> DataFrame:
    """(doc_id, text_key, block_no, template, label, containment) of every block that contains one.

    A block is a window of words, counted from 0 as block_no. text_key is a hash of the text, so
    that rows repeating a doc_id stay apart; equal rows give equal results, once for each.
    """
    spark = documents.sparkSession
    order = list(order or word_order(documents, templates))
    rows = template_rows(order, templates, percent)
    table = spark.createDataFrame(
        [(t, label, held, least, span, i, held[i]) for t, label, held, least, prefix, span in rows for i in range(prefix)],
        "template string, label string, held array<string>, least int, span int, i int, word string",
    )
    firsts = _any_of([w for _, _, held, _, prefix, _ in rows for w in held[:prefix]])
    known = f"array({quoted(order)})"
    # Windows of twice the longest span, one for each span: every run of that length lies in one.
    step = max(span for *_, span in rows)
    texts = documents.selectExpr("doc_id", "xxhash64(text) AS text_key", f"{lowered('text')} AS _t").where(
        f"_t RLIKE '{firsts}'"
    )
    blocks = (
        texts.selectExpr("doc_id", "text_key", "_t", f"{words('_t')} AS _w")
        .selectExpr(
            "doc_id", "text_key",
            f"posexplode(transform(sequence(0, size(_w) DIV {step}), i -> slice(_w, i * {step} + 1, {2 * step}))) AS (block_no, held_words)",
        )
        # In the corpus order: array_intersect keeps the order of its first argument.
        .selectExpr("*", f"array_intersect({known}, held_words) AS block")
        .where(f"size(block) >= {min(least for _, _, _, least, _, _ in rows)}")
    )
    # The best run of a template's span starts with one of its words.
    starts = "filter(sequence(1, size(held_words)), s -> array_contains(held, held_words[s - 1]))"
    runs = f"transform({starts}, s -> size(array_intersect(held, slice(held_words, s, span))))"
    return (
        blocks.selectExpr("*", "posexplode(block) AS (j, word)")
        # The table is fixed and small.
        .join(F.broadcast(table), "word")
        .where("size(block) >= least AND 1 + least(size(held) - i - 1, size(block) - j - 1) >= least")
        # The first common word alone stands for the pair.
        .where("word = array_intersect(block, held)[0] AND size(array_intersect(held, block)) >= least")
        .selectExpr(
            "doc_id", "text_key", "block_no", "template", "label", "size(held) AS _n", "least",
            f"array_max({runs}) AS _common",
        )
        .where("_common >= least")
        .selectExpr("doc_id", "text_key", "block_no", "template", "label", "_common / _n AS containment")
    )


def phrase_places(documents: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """doc_id, text_key, n_words, places (array of word index and label) of every row.

    Words are split for every whole text; places are looked for only in texts that hold
    a phrase at all.
    """
    split = documents.selectExpr("doc_id", "xxhash64(text) AS text_key", f"{words(lowered('text'))} AS w")
    found = []
    for phrase, label in phrases.items():
        first, *rest = phrase.split()
        same = " AND ".join([f"w[i] = '{first}'", *(f"get(w, i + {k}) = '{x}'" for k, x in enumerate(rest, 1))])
        # The lambda runs only for texts with all words of the phrase.
        has = " AND ".join(f"array_contains(w, '{x}')" for x in phrase.split())
        found.append(
            f"CASE WHEN {has} THEN transform(filter(sequence(0, size(w) - 1), i -> {same}),"
            f" i -> named_struct('place', CAST(i AS BIGINT), 'label', '{label}'))"
            " ELSE array() END"
        )
    return split.selectExpr("doc_id", "text_key", "CAST(size(w) AS BIGINT) AS n_words", f"concat({', '.join(found)}) AS places")


def license_scan(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row.

    Phrases give the base, blocks that contain a template add labels; score is the largest
    containment found, 1 where a phrase stands. Null and empty texts have no words, no
    labels and score 0. Repeated rows repeat their result, a null doc_id is kept. Other
    columns are not read.
    """
    blocks = (
        license_blocks(documents, percent=percent)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"), F.min("block_no").alias("first_block"))
        .selectExpr("doc_id AS _d", "text_key AS _k", "more", "best")
    )
    base = phrase_places(documents)
    joined = base.join(blocks, F.expr("doc_id <=> _d AND text_key <=> _k"), "left")
    return joined.selectExpr(
        "doc_id",
        "n_words",
        "CAST(size(places) AS BIGINT) AS n_base",
        "array_min(places.place) AS first_word",
        "array_max(places.place) AS last_word",
        "array_join(array_sort(array_distinct(places.label)), ',') AS base_labels",
        "array_join(array_sort(array_union(places.label, coalesce(more, array()))), ',') AS labels",
        "CASE WHEN size(places) > 0 THEN 1.0D ELSE coalesce(best, 0.0D) END AS score",
    )
