"""Counts by token and by pair.

Both are plain grouped counts: each map task adds up its own rows before the
shuffle, so a key that holds a large share of all rows reaches its reducer as
one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN_KEY = ("token",)
PAIR_KEY = ("left", "right")


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("cnt"))


def count_tokens(tokens: DataFrame) -> DataFrame:
    return count_by(tokens, *TOKEN_KEY)


def count_pairs(pairs: DataFrame) -> DataFrame:
    return count_by(pairs, *PAIR_KEY)
