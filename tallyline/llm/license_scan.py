"""License scans by diagonal voting, with DataFrame functions only.

A text's words are hashed in rolling windows of K words, and every hash is joined to the template
positions that have it. A hit votes for the diagonal (place in the text less place in the template)
of its template. Votes are added up by diagonal; neighbouring diagonals (an inserted or lost word
moves the rest of a text to the next one) are merged while their places stay close; a merged span is
verified by the share of the template that it has met. Each part of a template counts once for that,
however often a text repeats it: templates of up to SECTIONS windows are met window by window, longer
ones by as many sections of equal length.

Phrases are templates too. A place of a phrase is one diagonal with all windows of the phrase, at the
window numbers one after another, so its words stand consecutively; that gives the base labels. Base
labels stay; the method adds those of templates with at least LEAST_SHARE of their windows.

The templates are a fixed list, so their table is broadcast. Only hits are shuffled, by row, template
and diagonal, after they have been added up in each task. Null and empty texts have no words and no
labels. Repeated rows are scanned once each. Columns of the input other than doc_id and text are not
used, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 3
LEAST_SHARE = 0.6
NEAR = 4  # diagonals apart
CLOSE = 60  # words apart
SECTIONS = 62  # parts of a template that are told apart; they are the bits of a long

#: The phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Sentences of public license texts and the labels that they stand for.
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability": "mit-style",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "apache-2",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this work is licensed under a creative commons attribution": "cc-by",
    "this work is licensed under a creative commons attribution noncommercial": "cc-by-nc",
    "all rights reserved no part of this publication may be reproduced": "all-rights-reserved",
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAPS), lambda w: w != "")


def hashes_of(words: Column) -> Column:
    """The hash of each window of K words, in order."""
    n = F.size(words) - K + 1
    steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(K)]))


def template_windows(spark: SparkSession, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """template, label, is_phrase, at, hash and windows (how many the template has)."""
    rows = [(n, text, label, n < len(phrases)) for n, (text, label) in enumerate([*phrases.items(), *templates.items()])]
    table = spark.createDataFrame(rows, "template int, text string, label string, is_phrase boolean")
    hashes = hashes_of(words_of(F.col("text")))
    return table.select("template", "label", "is_phrase", F.size(hashes).alias("windows"), F.posexplode(hashes).alias("at", "hash"))


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, least_share: float = LEAST_SHARE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    spans lists label, first and last word and share of every span that counts. score is the largest
    share among the templates, 1 where a phrase stands.
    """
    known = F.broadcast(template_windows(docs.sparkSession, phrases, templates))  # a fixed list
    texts = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long"), words_of(F.col("text")).alias("words"))
    # A first entry without a place stands for the text itself, so that no second pass is needed.
    places = F.concat(
        F.array(F.struct(F.lit(-1).alias("place"), F.size("words").cast("long").alias("hash"))),
        F.transform(hashes_of(F.col("words")), lambda h, i: F.struct(i.alias("place"), h.alias("hash"))),
    )
    entries = texts.select("row_id", "doc_id", F.inline(places))
    of_text = F.col("place") < 0
    met = entries.join(known.withColumnRenamed("hash", "own"), (F.col("hash") == F.col("own")) & ~of_text, "left")
    met = met.filter(of_text | F.col("template").isNotNull())
    sections = F.least(F.lit(SECTIONS), F.col("windows"))
    section = F.floor(F.col("at") * sections / F.col("windows")).cast("int")
    met = met.withColumn("section", F.call_function("shiftleft", F.lit(1).cast("long"), section))
    diagonals = met.groupBy(
        "row_id", "doc_id", "template", "label", "is_phrase", "windows", (F.col("place") - F.col("at")).alias("diagonal")
    ).agg(
        F.count("at").alias("votes"),
        F.bit_or("section").alias("sections"),
        F.min("place").alias("first"),
        F.max("place").alias("last"),
        F.max(F.when(of_text, F.col("hash"))).alias("n_words"),
    )
    # A phrase's diagonal counts by itself; those of other templates are merged with their neighbours.
    line = Window.partitionBy("row_id", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(line) > NEAR) | (F.col("first") - F.max("last").over(line.rowsBetween(Window.unboundedPreceding, -1)) > CLOSE)
    fresh = F.when(F.col("is_phrase") | F.lag("diagonal").over(line).isNull() | apart, 1).otherwise(0)
    spans = diagonals.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(line))
    spans = spans.groupBy("row_id", "doc_id", "template", "label", "is_phrase", "windows", "span").agg(
        (F.bit_count(F.bit_or("sections")) / sections).alias("share"),
        F.sum("votes").alias("votes"),
        F.min("first").cast("long").alias("first"),
        (F.max("last") + K - 1).cast("long").alias("last"),
        F.max("n_words").alias("n_words"),
    )
    base = F.col("is_phrase") & (F.col("votes") >= F.col("windows"))  # a diagonal has each window once
    counts = base | (~F.col("is_phrase") & (F.col("share") >= least_share))
    labels = F.array_join(F.sort_array(F.collect_set(F.when(counts, F.col("label")))), ",")
    return spans.groupBy("row_id", "doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        labels.alias("labels"),
        F.coalesce(F.max(F.when(base | ~F.col("is_phrase"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(counts, F.struct("first", "last", "label", "share")))).alias("spans"),
    ).drop("row_id")


#: The places of the phrases, and their labels.
BASE_ORACLE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'
    ) AS w
  FROM documents
), words AS (
  SELECT r, unnest(w) AS a, generate_subscripts(w, 1) - 1 AS i FROM texts
), following AS (
  SELECT r, i, a, lead(a) OVER line AS b, lead(a, 2) OVER line AS c, lead(a, 3) OVER line AS d
  FROM words WINDOW line AS (PARTITION BY r ORDER BY i)
), places AS (
  SELECT r, i, CASE
    WHEN a = 'under' AND b = 'the' AND c = 'mit' AND d = 'license' THEN 'mit'
    WHEN a = 'apache' AND b = 'license' AND c = 'version' AND d = '2' THEN 'apache-2'
    WHEN a = 'cc' AND b = 'by' AND c = 'nc' THEN 'cc-by-nc'
  END AS label
  FROM following
), found AS (
  SELECT r, count(*) AS n, min(i) AS low, max(i) AS high, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places WHERE label IS NOT NULL GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
  CAST(low AS BIGINT) AS first_word, CAST(high AS BIGINT) AS last_word, coalesce(labels, '') AS base_labels
FROM texts LEFT JOIN found USING (r)
"""
