"""Tokens and token pairs of a corpus, one row each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions import accepted_tokens, rules


def explode_tokens(corpus: DataFrame, text: str = "value") -> DataFrame:
    """One row per accepted token, next to the other columns.

    A line end is never part of a token, so ``text`` may hold a line or a
    whole document.
    """
    others = [name for name in corpus.columns if name != text]
    return corpus.select(*others, F.explode(accepted_tokens(F.col(text))).alias("token"))


def explode_pairs(
    lines: DataFrame, text: str = "value", window: int = rules.PAIR_WINDOW
) -> DataFrame:
    """One row per ordered pair of accepted tokens at distance 1 to ``window``.

    ``text`` must hold one line, as pairs never cross lines. The tokens of a
    line are laid next to themselves shifted by each distance, so the work
    stays in the map task and needs no shuffle and no lambda.
    """
    others = [name for name in lines.columns if name != text]
    distances = range(1, window + 1)
    shifted = [F.slice("tokens", d + 1, F.size("tokens")).alias(f"after{d}") for d in distances]
    followers = [f"after{d}" for d in distances]
    return (
        lines.select(*others, accepted_tokens(F.col(text)).alias("tokens"))
        .select(
            *others,
            F.inline(F.arrays_zip(F.col("tokens").alias("left"), *shifted)).alias(
                "left", *followers
            ),
        )
        .select(*others, "left", F.explode(F.array(*followers)).alias("right"))
        .where(F.col("right").isNotNull())
    )
