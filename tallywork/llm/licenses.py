"""License scans by diagonal voting.

Every run of three words of a text is looked up among the runs of the license
templates. A hit at word p of the text and word q of a template votes for the
diagonal p - q: a template that stands in the text as it is puts all its votes
on one diagonal, and a word added or left out moves the rest to the next.
Votes are gathered per diagonal. Each diagonal is merged with its neighbours
above, as far as words may be added to the template, and the merged band counts
if enough of the template's runs are in it, each counted once. So it does not
matter how often a statement is broken, whether its own words are repeated in
between, or which other hits lie near it. A band is as long as the template and
the words that may be added, so no span is much longer than its template.

The templates are a fixed list, so looking them up is a broadcast join of a
known size, and only hits are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywork.llm.common import null_safe_join, row_key, text_or_empty

# The phrases that must be found wherever their words stand
# consecutively, and their labels.
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Statements of other licenses and longer ones of the same, as
# their authors publish them, in lower case without punctuation.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "cc0 1 0 universal public domain dedication"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
)
WORD_PATTERN = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
GRAM_WORDS = 3
#: Words that may be added to a template: a share of its words, and some more.
ADDED_SHARE, ADDED_WORDS = 0.25, 4
#: Share of a template's runs that a span must have.
LEAST_SCORE = 0.8

KEY = ["key_id", "key_text"]


def words(text: Column) -> Column:
    """The words of a text with A-Z in lower case.

    ``lower`` is several times faster than a table of 26 letters. It also
    changes letters beyond ASCII, which no template holds; only the Kelvin
    sign would become an ASCII letter, so it is swapped for another one first.
    """
    plain = F.replace(text_or_empty(text), F.lit("K"), F.lit("ĸ"))
    return F.regexp_extract_all(F.lower(plain), F.lit(WORD_PATTERN), F.lit(0))


def grams(rows: DataFrame, kept: list[str]) -> DataFrame:
    """``kept``, the place of each run of three words, and the words.

    ``rows`` has the words as an array in column ``words``.
    """
    n = F.size("words")
    shifted = [F.slice("words", i + 1, F.greatest(n - i, F.lit(0))).alias(f"w{i}") for i in range(GRAM_WORDS)]
    place = F.posexplode(F.arrays_zip(*shifted)).alias("place", "gram")
    runs = rows.where(n >= GRAM_WORDS).select(*kept, place)
    names = [f"w{i}" for i in range(GRAM_WORDS)]
    runs = runs.select(*kept, "place", *[F.col(f"gram.{w}").alias(w) for w in names])
    return runs.where(F.col(names[-1]).isNotNull())


def template_grams(spark: SparkSession) -> DataFrame:
    """All runs of all templates: ``template``, ``label``, ``is_base``, ``n_runs``, ``reach``, ``at``, words.

    ``reach`` is how many diagonals lie in one band beside its first.
    """
    listed = [(label, text, True) for label, text in BASE_PHRASES]
    listed += [(label, text, False) for label, text in TEMPLATES]
    literal = F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(base).alias("is_base"), F.lit(text).alias("text"))
        for i, (label, text, base) in enumerate(listed)
    ])
    rows = spark.range(1).select(F.inline(literal))
    rows = rows.withColumn("words", F.split("text", " "))
    rows = rows.withColumn("n_runs", F.size("words") - (GRAM_WORDS - 1))
    reach = F.floor(F.size("words") * ADDED_SHARE).cast("int") + ADDED_WORDS
    rows = rows.withColumn("reach", F.when(F.col("is_base"), 0).otherwise(reach))
    kept = ["template", "label", "is_base", "n_runs", "reach"]
    return grams(rows, kept).withColumnRenamed("place", "at")


def license_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per span: the row's key, ``label``, ``is_base``, ``first_word``, ``last_word``, ``score``.

    ``is_base`` spans are the places of the base phrases, each on a diagonal
    of its own. A statement that stands several times in a text is one span
    for every run of bands that are no further apart than words may be added.
    Words count from 0. Null and empty texts have no spans, copies of a row
    have theirs once, no rows give no rows, other columns are not looked at.
    """
    rows = docs.select(*row_key(doc_id, text), words(F.col(text)).alias("words"))
    names = [f"w{i}" for i in range(GRAM_WORDS)]
    known = F.broadcast(template_grams(docs.sparkSession))
    hits = grams(rows, KEY).join(known, names).drop(*names)
    hits = hits.withColumn("diagonal", (F.col("place") - F.col("at")).cast("int"))
    # Copies of a row vote once; a diagonal holds a run of the template once.
    group = [*KEY, "template", "label", "is_base", "n_runs", "reach"]
    votes = hits.groupBy(*group, "diagonal").agg(F.collect_set("at").alias("ats"))
    widest = max(int(len(told.split()) * ADDED_SHARE) + ADDED_WORDS for _, told in TEMPLATES)
    above = Window.partitionBy(*KEY, "template").orderBy("diagonal").rangeBetween(0, widest)
    bands = votes.withColumn("near", F.collect_list(F.struct("diagonal", "ats")).over(above))
    bands = bands.withColumn("band", F.filter("near", lambda v: v.diagonal <= F.col("diagonal") + F.col("reach"))).drop("near")
    share = F.size(F.array_distinct(F.flatten("band.ats"))) / F.col("n_runs")
    bands = bands.withColumn("score", share)
    bands = bands.where(F.col("score") >= F.when(F.col("is_base"), 1.0).otherwise(LEAST_SCORE))
    first = F.transform("band", lambda v: v.diagonal + F.array_min(v.ats))
    last = F.transform("band", lambda v: v.diagonal + F.array_max(v.ats))
    bands = bands.withColumns({"first": F.array_min(first), "last": F.array_max(last)})
    # Bands of one statement overlap; the best of them, then the first, tells its span.
    along = Window.partitionBy(*KEY, "template").orderBy("diagonal")
    apart = F.col("is_base") | (F.col("diagonal") - F.lag("diagonal").over(along) > F.col("reach"))
    bands = bands.withColumn("opens", F.when(apart, 1).otherwise(0))
    bands = bands.withColumn("span", F.sum("opens").over(along))
    best = F.max_by(F.struct("first", "last", "score"), F.struct("score", -F.col("diagonal")))
    spans = bands.groupBy(*KEY, "template", "label", "is_base", "span").agg(best.alias("best"))
    return spans.select(
        *KEY, "label", "is_base", F.col("best.first").cast("bigint").alias("first_word"),
        (F.col("best.last") + GRAM_WORDS - 1).cast("bigint").alias("last_word"), F.col("best.score").alias("score"),
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    ``n_base`` counts all places of base phrases; ``first_word`` and
    ``last_word`` are the smallest and largest start of one. ``labels`` also
    has those of other spans. ``score`` is the best of any span.

    Null and empty texts have no words, no labels (empty strings) and score 0.
    Null ids are kept. Copies of a row, and rows of one id with different
    texts, each get their own result. No rows give no rows. Other columns are
    not looked at.
    """
    found = license_spans(docs, doc_id, text)
    base = F.col("is_base")
    label_list = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    summed = found.groupBy(*KEY).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        label_list(F.when(base, F.col("label"))).alias("base_labels"),
        label_list("label").alias("labels"),
        F.max("score").alias("score"),
    )
    n_words = F.regexp_count(text_or_empty(F.col(text)), F.lit(WORD_PATTERN)).cast("bigint")
    rows = docs.select(*row_key(doc_id, text), n_words.alias("n_words"))
    joined = null_safe_join(rows, summed, KEY, "left")
    return joined.select(
        F.col("key_id").alias("doc_id"), "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
