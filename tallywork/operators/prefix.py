"""The same counts and selections for a growing series of sources.

Step s covers the sources numbered 0 to s. The corpus is read once: rows are
counted by source and key, and a running sum over the sources of each key
gives its count at every step. That is kept as spans, one row per run of
steps over which a key keeps its count. Selections by count look at spans
first and spell out single steps afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions import rules
from tallywork.operators.counts import PAIR_KEY, TOKEN_KEY, count_by
from tallywork.operators.select import (
    count_equals,
    number_word_pairs,
    word_word_pairs,
    words_only,
)


#: Parts in which the spans of a step are ranked first.
PARTS = 256


def count_spans(rows: DataFrame, keys: tuple[str, ...], last_step: int | Column) -> DataFrame:
    """``*keys``, ``first_step``, ``last_step``, ``cnt`` from rows with a ``step``.

    A window partition holds one row per source of a key, however many rows
    of the corpus the key has.
    """
    last = last_step if isinstance(last_step, Column) else F.lit(last_step)
    # Sorted by a hash first, as numbers compare faster than words do.
    by_key = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy("step")
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return count_by(rows, "step", *keys).select(
        *keys,
        F.col("step").alias("first_step"),
        F.coalesce(F.lead("step").over(by_key) - 1, last).alias("last_step"),
        F.sum("cnt").over(so_far).alias("cnt"),
    )


def token_spans(tokens: DataFrame, last_step: int | Column) -> DataFrame:
    return count_spans(tokens, TOKEN_KEY, last_step)


def pair_spans(pairs: DataFrame, last_step: int | Column) -> DataFrame:
    return count_spans(pairs, PAIR_KEY, last_step)


def by_step(spans: DataFrame) -> DataFrame:
    """One row per step and key: ``step``, the key columns, ``cnt``."""
    keys = [name for name in spans.columns if name not in ("first_step", "last_step", "cnt")]
    steps = F.explode(F.sequence("first_step", "last_step")).alias("step")
    return spans.select(steps, *keys, "cnt")


def prefix_words_with_count(spans: DataFrame, n: int = rules.COUNT_WANTED) -> DataFrame:
    return by_step(count_equals(words_only(spans), n))


def prefix_word_pairs_with_count(
    spans: DataFrame, n: int = rules.COUNT_WANTED, accepted: bool = False
) -> DataFrame:
    return by_step(count_equals(word_word_pairs(spans, accepted), n))


def _top_by_step(spans: DataFrame, k: int, keys: tuple[str, ...]) -> DataFrame:
    order = [F.desc("cnt"), *keys]
    # Counts only grow. A span with k better ones that start at the same step
    # is therefore outside the first k at every step it covers, so at most k
    # spans per first step are spelled out.
    # Ranked within parts of a group first, so that no task is given the whole
    # vocabulary of a step, however large k is.
    part = F.pmod(F.xxhash64(*keys), F.lit(PARTS))
    spans = _first_k(spans.withColumn("part", part), k, ["first_step", "part"], order).drop("part")
    candidates = _first_k(spans, k, ["first_step"], order)
    return _first_k(by_step(candidates), k, ["step"], order)


def _first_k(rows: DataFrame, k: int, group: list[str], order: list) -> DataFrame:
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("rank") <= k).drop("rank")


def prefix_top_words(spans: DataFrame, k: int = rules.TOP_K) -> DataFrame:
    return _top_by_step(words_only(spans), k, TOKEN_KEY)


def prefix_top_number_word_pairs(spans: DataFrame, k: int = rules.TOP_K) -> DataFrame:
    return _top_by_step(number_word_pairs(spans), k, PAIR_KEY)
