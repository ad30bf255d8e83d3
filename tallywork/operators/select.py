"""Selections on token and pair tables.

Each is a row-wise filter. On a freshly counted table the filters on the key
move below the aggregate, so rejected keys are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions import ends_in_digit, is_number, is_word, rules
from tallywork.operators.counts import PAIR_KEY, TOKEN_KEY


def words_only(table: DataFrame) -> DataFrame:
    return table.where(is_word(F.col("token")))


def word_word_pairs(table: DataFrame, accepted: bool = False) -> DataFrame:
    """Pairs of words. If all keys are ``accepted`` tokens, a glance at their ends tells."""
    if accepted:
        return table.where(~ends_in_digit(F.col("left")) & ~ends_in_digit(F.col("right")))
    return table.where(is_word(F.col("left")) & is_word(F.col("right")))


def number_word_pairs(table: DataFrame) -> DataFrame:
    return table.where(is_number(F.col("left")) & is_word(F.col("right")))


def count_equals(counts: DataFrame, n: int = rules.COUNT_WANTED) -> DataFrame:
    return counts.where(F.col("cnt") == F.lit(n))


def words_with_count(counts: DataFrame, n: int = rules.COUNT_WANTED) -> DataFrame:
    return count_equals(words_only(counts), n)


def word_pairs_with_count(
    counts: DataFrame, n: int = rules.COUNT_WANTED, accepted: bool = False
) -> DataFrame:
    return count_equals(word_word_pairs(counts, accepted), n)


def _top(counts: DataFrame, k: int, keys: tuple[str, ...]) -> DataFrame:
    # Ties are broken by the key, so the k rows are always the same ones.
    return counts.orderBy(F.desc("cnt"), *keys).limit(k)


def top_words(counts: DataFrame, k: int = rules.TOP_K) -> DataFrame:
    return _top(words_only(counts), k, TOKEN_KEY)


def top_number_word_pairs(counts: DataFrame, k: int = rules.TOP_K) -> DataFrame:
    return _top(number_word_pairs(counts), k, PAIR_KEY)
