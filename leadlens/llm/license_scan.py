"""License scans by diagonal voting (operator 1).

Templates are word sequences of license notices.  Every rolling word pair of a text
is hashed and joined to the template positions with the same hash; the words
themselves are compared in the join, so hash collisions fall out at once.  A hit at text
word p and template word t votes for the diagonal p - t:

* votes are counted per (document, template, diagonal), with a map-side partial sum;
* neighbouring diagonals (a word or two put in or left out) are merged into one span;
* a span is verified by the share of the template's words that its hits cover.  A base
  phrase must be covered whole on one diagonal; a notice must reach ``MIN_COVER``, and
  the words that tell its license from others must be among the covered ones: its
  numbers, and the words in which it differs from a notice of another label that is as
  long and otherwise alike ("nc" and "sa", the versions of one license).  So a notice
  with a word changed, put in or left out is found, and another version is not.

The template table has a fixed size (it is made from the constants below), so it is
broadcast.  A text is exploded into words inside its own task and collapses to one row
per diagonal before the only shuffles, so a hot source or a passage shared by many
documents adds no load to any single task.

Cases: a null or empty text has no words and yields no span; repeated rows are scanned
row by row; ids may be null; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlens.llm.common import ASCII_LOWER, ascii_lower, table

#: words of this operator: runs of ASCII letters and digits and all code points beyond ASCII
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: the same class for Java, which matches a negated union of ranges many times slower
JAVA_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"

# The base phrases with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices of public licenses with their labels.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                "the License, or (at your option) any later version"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
]

MIN_COVER = 0.8
MAX_SHIFT = 2
#: the hits of a diagonal are the bits of one long
MAX_WORDS = 63


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate(ASCII_LOWER))


def _templates() -> list[tuple[int, str, bool, list[str]]]:
    rows = [(label, True, words_of(t)) for t, label in BASE.items()]
    rows += [(label, False, words_of(t)) for label, t in NOTICES]
    return [(i, label, base, w) for i, (label, base, w) in enumerate(rows)]


def _telling(words: list[str], label: str, templates, min_cover: float) -> set[int]:
    """Positions that a span must cover: numbers, and words that tell alike notices apart."""
    must = {t for t, w in enumerate(words) if w.isdigit()}
    for _, other, base, rival in templates:
        if not base and other != label and len(rival) == len(words):
            differ = {t for t, (v, w) in enumerate(zip(words, rival)) if v != w}
            if len(differ) <= (1 - min_cover) * len(words):
                must |= differ
    return must


def template_positions(templates=None, min_cover: float = MIN_COVER) -> list[tuple]:
    """(template, label, base, words, bits of the words that must be covered, position, word, next word)."""
    templates = templates or _templates()
    if any(not 2 <= len(w) <= MAX_WORDS for _, _, _, w in templates):
        raise ValueError(f"a template has 2 to {MAX_WORDS} words")
    return [(tid, label, base, len(w), 0 if base else sum(1 << t for t in _telling(w, label, templates, min_cover)),
             t, w[t], w[t + 1])
            for tid, label, base, w in templates for t in range(len(w) - 1)]


def _under(pairs: Column) -> Column:
    """Bits of the template words under the pairs whose starts are the set bits of ``pairs``."""
    return pairs.bitwiseOR(F.shiftleft(pairs, 1))


def _covered(pairs: Column) -> Column:
    return F.bit_count(_under(pairs))


def license_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", templates=None,
                  min_cover: float = MIN_COVER, max_shift: int = MAX_SHIFT) -> DataFrame:
    """Verified spans: one row per span, and one row without a template per document.

    Columns: ``_row`` (of the input row), doc_id, n_words, template, label, base,
    start, end (word positions, end past the last), cover (0 to 1), exact.
    """
    spark = docs.sparkSession
    pos = F.broadcast(spark.createDataFrame(
        template_positions(templates, min_cover),
        "tid int, label string, base boolean, len int, must long, tpos int, a string, b string")
        .withColumn("gram", F.xxhash64("a", "b")))
    words = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(doc_id).alias("doc_id"),
                        F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(JAVA_WORD),
                                             F.lit(0)).alias("w"))
    n = F.size("w")
    grams = (words.withColumns({"n_words": n.cast("long"),
                                "w": F.arrays_zip(F.col("w").alias("w0"),
                                                  F.slice("w", 2, F.greatest(n, F.lit(1))).alias("w1"))})
             .select("_row", "doc_id", "n_words", F.posexplode_outer("w").alias("p", "g"))
             .select("_row", "doc_id", "n_words", "p", "g.*"))
    hits = grams.join(pos, (F.xxhash64("w0", "w1") == F.col("gram")) & (F.col("w0") == F.col("a"))
                      & (F.col("w1") == F.col("b")), "left")
    # one row per diagonal; words without a hit fall into one row per document
    votes = (hits.groupBy("_row", "doc_id", "n_words", "tid", "label", "base", "len", "must",
                          (F.col("p") - F.col("tpos")).alias("diag"))
             .agg(F.bit_or(F.expr("shiftleft(1L, tpos)")).alias("pairs"), F.min("tpos").alias("t0"),
                  F.max("tpos").alias("t1"))
             .repartition("_row"))
    by_diag = Window.partitionBy("_row", "tid").orderBy("diag")
    # a whole match stands alone; other diagonals join their neighbour
    whole = _covered(F.col("pairs")) == F.col("len")
    near = votes.withColumn("exact", whole).withColumn(
        "new", F.when(F.col("exact") | F.coalesce(F.lag("exact").over(by_diag), F.lit(True))
                      | (F.col("diag") - F.lag("diag").over(by_diag) > max_shift), 1).otherwise(0))
    spans = (near.withColumn("span", F.sum("new").over(by_diag))
             .groupBy("_row", "doc_id", "n_words", "tid", "label", "base", "len", "must", "span")
             .agg(F.bit_or("pairs").alias("pairs"), F.bool_or("exact").alias("exact"),
                  F.min(F.col("diag") + F.col("t0")).cast("long").alias("start"),
                  F.max(F.col("diag") + F.col("t1") + 2).cast("long").alias("end"))
             .withColumn("cover", _covered(F.col("pairs")) / F.col("len")))
    told = _under(F.col("pairs")).bitwiseAND(F.col("must")) == F.col("must")
    kept = F.col("tid").isNull() | F.col("exact") | (~F.col("base") & (F.col("cover") >= min_cover) & told)
    return spans.filter(kept).select("_row", "doc_id", "n_words", F.col("tid").alias("template"), "label", "base",
                                     "start", "end", "cover", "exact")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = license_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    start = F.when(F.col("base"), F.col("start"))
    join = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (s.groupBy("_row", "doc_id", "n_words")
            .agg(F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
                 join(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
                 join(F.col("label")).alias("labels"),
                 F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"))
            .drop("_row"))


QUERIES = {"op1_license_scan": op1_license_scan}


def _oracle() -> str:
    values = ", ".join(f"({tid}, '{label}', {str(base).lower()}, {n}, {[k for k in range(n) if must >> k & 1]}::INT[], "
                       f"{t}, '{a}', '{b}')" for tid, label, base, n, must, t, a, b in template_positions())
    cover = "len(list_distinct(list_concat({0}, list_transform({0}, lambda x: x + 1))))"
    return rf"""
WITH pos(tid, label, base, len, must, tpos, a, b) AS (VALUES {values}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
g AS (SELECT doc_id, unnest(w) AS w0, unnest(w[2:]) AS w1, unnest(range(0, len(w))) AS p FROM d),
v AS (SELECT doc_id, tid, label, base, len, must, p - tpos AS diag, list(DISTINCT tpos) AS ts,
             {cover.format('list(DISTINCT tpos)')} = len AS exact
      FROM g JOIN pos ON w0 = a AND w1 = b
      GROUP BY doc_id, tid, label, base, len, must, p - tpos),
m AS (SELECT *, CASE WHEN exact OR coalesce(lag(exact) OVER o, true) OR diag - lag(diag) OVER o > {MAX_SHIFT}
             THEN 1 ELSE 0 END AS new FROM v WINDOW o AS (PARTITION BY doc_id, tid ORDER BY diag)),
s AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, tid ORDER BY diag) AS span FROM m),
f AS (SELECT doc_id, tid, label, base, len, must, span, bool_or(exact) AS exact, flatten(list(ts)) AS ts,
             min(diag + list_min(ts)) AS start FROM s GROUP BY doc_id, tid, label, base, len, must, span),
k AS (SELECT *, {cover.format('ts')} / len AS cover FROM f
      WHERE exact OR (NOT base AND {cover.format('ts')} / len >= {MIN_COVER}
                      AND list_has_all(list_concat(ts, list_transform(ts, lambda x: x + 1)), must)))
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, count(start) FILTER (base) AS n_base,
       min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       coalesce(max(cover), 0)::DOUBLE AS score
FROM d LEFT JOIN k USING (doc_id) GROUP BY d.doc_id, d.w"""


ORACLE = {"op1_license_scan": _oracle()}
