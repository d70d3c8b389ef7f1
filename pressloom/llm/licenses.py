"""License scan by diagonal voting, with DataFrame operations only.

All rolling word k-gram hashes of every text are joined to the positions at which the same grams stand in a template.  A hit
at document word d and template word t votes for the diagonal d - t: an unchanged copy of a template puts all its votes on
one diagonal, a copy with inserted or dropped words on neighbouring ones.  Diagonals at most `shift` apart are merged into a
span, and a span counts if the distinct template grams found in it, compared word by word and not only by hash, cover
`least` of the template.

Two gram lengths run through the same join: PHRASES (bigrams, no shift, full cover: a phrase's words stand consecutively)
give the base places and labels, TEMPLATES (four-grams) add labels of their own.

The template grams are a fixed list, so their table is broadcast.  Only hits and one anchor row per document are shuffled,
by row; a document's hits are bounded by its own length.

Edge cases: NULL and empty texts have no words, no places, empty label strings and score 0; repeated rows give a result row
each; a NULL doc_id is carried through; other columns are never looked at.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.llm import common


class Template(NamedTuple):
    label: str
    text: str


SHORT, LONG = 2, 4
SHIFT, LEAST = 3, 0.5

# The phrases and labels of the query's contract.
PHRASES = (Template("mit", "mit license"), Template("apache", "apache license"), Template("gpl", "general public license"))

# Opening and notice sentences by which public licences are applied.
TEMPLATES = (
    Template("mit", "Released under the MIT License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)


def split_words(text: str) -> list[str]:
    """The word rule for the driver's short template texts."""
    return re.findall(common.WORD, text.translate(str.maketrans(common.UPPER, common.LOWER)))


def template_grams(phrases=PHRASES, templates=TEMPLATES) -> list[tuple]:
    """(template number, label, base?, allowed shift, least cover, gram count, gram length, position, gram words)."""
    out = []
    for base, size, group in ((True, SHORT, phrases), (False, LONG, templates)):
        for t in group:
            w = split_words(t.text)
            count = len(w) - size + 1
            number = 1000 * base + group.index(t)
            for i in range(count):
                out.append((number, t.label, base, 0 if base else SHIFT, 1.0 if base else LEAST, count, size, i, " ".join(w[i : i + size])))
    return out


def gram_table(spark: SparkSession, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    rows = ", ".join(
        f"({number}, '{label}', {base}, {shift}, {least}D, {grams}, {size}, {at}, '{gram}')"
        for number, label, base, shift, least, grams, size, at, gram in template_grams(phrases, templates)
    )
    table = spark.sql(f"SELECT * FROM VALUES {rows} AS t(template, label, base, shift, least, grams, size, at, gram)")
    return table.withColumn("h", common.gram_hash(F.split("gram", " "), F.lit(0), LONG))


def votes(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """Rows (row, doc_id, n_words) as anchors, and (row, template columns, word, at) for each verified gram hit."""
    step, n, word = F.col("step"), F.col("n_words"), F.shiftright("step", 1)
    base = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", common.words("text").alias("w")).withColumn("n_words", F.size("w"))
    # Two elements per word, one for each gram length, and a last one as the anchor.
    walk = base.select("row", "doc_id", "w", "n_words", F.explode(F.sequence(F.lit(0), n * 2)).alias("step"))
    short = (step % 2 == 0) & (word <= n - SHORT)
    long = (step % 2 == 1) & (word <= n - LONG)
    h = F.when(short, common.gram_hash("w", word, SHORT)).when(long, common.gram_hash("w", word, LONG))
    probed = walk.select("row", "doc_id", "w", "n_words", "step", h.alias("h"))
    anchor = step == n * 2
    found = probed.join(F.broadcast(grams), "h", "left").where(anchor | (F.col("gram") == F.array_join(F.slice("w", word + 1, F.col("size")), " ")))
    return found.select(
        "row",
        *[F.when(anchor, F.col(c)).alias(c) for c in ("doc_id", "n_words")],
        *[F.when(~anchor, F.col(c)).alias(c) for c in ("template", "label", "base", "shift", "least", "grams", "at")],
        F.when(~anchor, word).alias("word"),
    )


def spans(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """Verified spans (row, label, base, start, words, cover), beside one anchor (row, doc_id, n_words, label NULL) per row."""
    word, at = F.col("word"), F.col("at")
    about = ("label", "base", "shift", "least", "grams", "doc_id", "n_words")
    diagonals = (
        votes(docs, grams)
        .withColumn("diagonal", word - at)
        .groupBy("row", "template", "diagonal")
        .agg(*[F.max(c).alias(c) for c in about], F.min(word).alias("first"), F.max(word).alias("last"), F.collect_set(at).alias("found"))
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > F.col("shift"), F.lit(True))
    numbered = diagonals.withColumn("far", far.cast("int")).withColumn("span", F.sum("far").over(order))
    merged = numbered.groupBy("row", "template", "span").agg(
        *[F.max(c).alias(c) for c in about],
        F.min("first").alias("start"),
        F.max("last").alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n_found"),
    )
    cover = (F.col("n_found") / F.col("grams")).alias("cover")
    size = F.when(F.col("base"), F.lit(SHORT)).otherwise(F.lit(LONG))
    checked = merged.select("row", "doc_id", "n_words", "label", "base", "least", "start", (F.col("last") - F.col("start") + size).alias("words"), cover)
    return checked.where(F.col("label").isNull() | (F.col("cover") >= F.col("least")))


def report(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    found = spans(docs, gram_table(docs.sparkSession, phrases, templates))
    base, start = F.col("base"), F.col("start")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return found.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, start)).cast("long").alias("first_word"),
        F.max(F.when(base, start)).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined("label").alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.count(F.when(~base, 1)).alias("n_template_spans"),
    ).drop("row")


def sql() -> str:
    """DuckDB counterpart, on words instead of hashes, from the same templates."""
    values = ",\n".join(f"({t},'{lab}',{str(b).lower()},{s},{le},{g},{k},{i},'{w}')" for t, lab, b, s, le, g, k, i, w in template_grams())
    return rf"""
WITH g(template,label,base,shift,least,grams,size,tpos,gram) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'), '{common.WORD}') AS w FROM documents),
i AS (SELECT r, w, size, unnest(range(len(w) - size + 1)) AS word FROM d, (SELECT DISTINCT size FROM g) WHERE len(w) >= size),
v AS (SELECT i.r, i.word, g.* FROM i JOIN g ON g.size = i.size AND g.gram = array_to_string(i.w[word + 1 : word + i.size], ' ')),
n AS (SELECT *, sum(far) OVER (PARTITION BY r, template ORDER BY word - tpos, word) AS span FROM (
    SELECT *, CASE WHEN (word - tpos) - lag(word - tpos) OVER (PARTITION BY r, template ORDER BY word - tpos, word) <= shift THEN 0 ELSE 1 END AS far FROM v)),
m AS (SELECT r, template, label, base, min(word) AS start, count(DISTINCT tpos) / any_value(grams) AS cover FROM n
    GROUP BY r, template, label, base, span HAVING count(DISTINCT tpos) / any_value(grams) >= any_value(least))
SELECT doc_id, CAST(len(any_value(w)) AS BIGINT) AS n_words, count(start) FILTER (WHERE base) AS n_base,
  CAST(min(start) FILTER (WHERE base) AS BIGINT) AS first_word, CAST(max(start) FILTER (WHERE base) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(cover), 0.0) AS score,
  count(start) FILTER (WHERE NOT base) AS n_template_spans
FROM d LEFT JOIN m USING (r) GROUP BY r, doc_id
"""
