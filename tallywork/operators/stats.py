"""Median, rows above a scalar, and group means.

Scalar results are one-row DataFrames. Used inside another query they become
scalar subqueries, so nothing is joined and nothing is collected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.functions import null_default, rules
from tallywork.session import scratch_path


def _numbers(df: DataFrame, value: str, default: float | None) -> DataFrame:
    filled = F.col(value) if default is None else null_default(F.col(value), default)
    v = F.col("v")
    return df.select(filled.cast("double").alias("v")).where(v.isNotNull() & ~F.isnan(v))


def _sketched(values: DataFrame, size: int) -> DataFrame:
    """One row with a KLL sketch of ``v``, merged in two levels.

    Each task sends one sketch, at scale hundreds of thousands. They are merged
    in ``SKETCH_GROUPS`` groups first, so the last task gets one per group.
    """
    dealt = values.select("v", (F.spark_partition_id() % SKETCH_GROUPS).alias("sketch_group"))
    some = dealt.groupBy("sketch_group").agg(F.kll_sketch_agg_double("v", F.lit(size)).alias("sketch"))
    return some.agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


SKETCH_GROUPS = 64
#: The largest sketch: ranks are off by about one in ten thousand.
SKETCH_SIZE = 65_535


def _rank_error(size: int) -> float:
    """How far off a rank is at most, nearly always, as a share of all rows."""
    return 2.3 / size**0.9


def median_approx(
    df: DataFrame,
    value: str,
    default: float | None = rules.MISSING_VALUE_DEFAULT,
    relative_error: float = rules.MEDIAN_RELATIVE_ERROR,
) -> DataFrame:
    """An element whose rank is within ``relative_error`` of the middle, as ``median``.

    Each task sends one small sketch; the value column is read once. Sketches
    of a tenth of the error wanted are used, as they draw lots.
    """
    size = min(SKETCH_SIZE, max(200, math.ceil((23 / relative_error) ** (1 / 0.9))))
    values = _numbers(df, value, default)
    middle = F.kll_sketch_get_quantile_double("sketch", F.lit(0.5))
    known = F.kll_sketch_get_n_double("sketch") > 0
    return _sketched(values, size).select(F.when(known, middle).alias("median"))


def median_exact(
    df: DataFrame,
    value: str,
    default: float | None = rules.MISSING_VALUE_DEFAULT,
    sketch_size: int = SKETCH_SIZE,
    settle_rows: int = 1_000_000,
) -> DataFrame:
    """The lower middle element, as ``median``; null if there are no values.

    While more than ``settle_rows`` rows are left, a sketch gives two values
    that enclose the wanted rank, and one pass counts the rows below them, at
    them and between them. Either one of the two is the median, or only the
    rows strictly between them are left: about four in ten thousand, whatever
    the distribution and however often a value repeats. They are written to
    the shared folder, so the table is read four times however large it is.
    The counts are exact, so sketches only decide how fast this goes. The
    driver sees one row per pass. The rows left at the end, for which a table
    of up to ``settle_rows`` needs no sketch, are ranked value by value.
    """
    v = F.col("v")
    left = _numbers(df, value, default)
    held = left.count()
    rank, margin = (held + 1) // 2, 2 * _rank_error(sketch_size)
    while held > settle_rows:
        low, high = _enclosing(left, sketch_size, rank / held, margin)
        inside = (v > low) & (v < high)
        seen = left.agg(
            F.count_if(v < low).alias("below"),
            F.count_if(v == low).alias("at_low"),
            F.count_if(inside).alias("between"),
            F.count_if((v == high) & (v > low)).alias("at_high"),
        ).first()
        past_low = rank - seen["below"] - seen["at_low"]
        past_between = past_low - seen["between"]
        if rank <= seen["below"] or past_between > seen["at_high"]:
            margin *= 2
        elif past_low <= 0 or past_between > 0:
            found = low if past_low <= 0 else high
            return df.sparkSession.range(1).select(F.lit(found).alias("median"))
        else:
            path = scratch_path(df.sparkSession, "median")
            left.where(inside).write.parquet(path)
            left, held, rank = df.sparkSession.read.parquet(path), seen["between"], past_low
            margin = 2 * _rank_error(sketch_size)
    up_to = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = left.groupBy("v").agg(F.count("*").alias("cnt")).select(
        "v", F.sum("cnt").over(up_to).alias("reached")
    )
    # The aggregate also gives the null row for a table without values.
    return ranked.where(F.col("reached") >= rank).agg(F.min("v").alias("median"))


def _enclosing(values: DataFrame, size: int, share: float, margin: float) -> tuple[float, float]:
    shares = F.array(F.lit(max(share - margin, 0.0)), F.lit(min(share + margin, 1.0)))
    found = _sketched(values, size).select(F.kll_sketch_get_quantile_double("sketch", shares).alias("ends"))
    return tuple(found.first()["ends"])


def above_scalar(df: DataFrame, value: str, scalar: DataFrame) -> DataFrame:
    """Rows strictly above a one-row, one-column DataFrame; null never qualifies."""
    return df.where(F.col(value) > scalar.scalar())


def above_median(
    df: DataFrame, value: str, name: str, shown: str, median: DataFrame
) -> DataFrame:
    """``name`` and ``shown`` of the rows above the median, ordered by name."""
    # The second sort key lets the range partitioner split a frequent name.
    return above_scalar(df, value, median).select(name, shown).orderBy(name, shown)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("cnt"))


def group_mean(df: DataFrame, group: str, value: str) -> DataFrame:
    """``group`` and ``mean``, ordered by group; null values are ignored."""
    return df.groupBy(group).agg(F.avg(value).alias("mean")).orderBy(group)


def group_mean_gap(
    df: DataFrame,
    group: str,
    value: str,
    first: object,
    second: object,
    limit: float = rules.GAP_LIMIT,
) -> DataFrame:
    """Means of two groups, their absolute gap and a verdict, in one pass.

    A group without values gives a null mean, gap and verdict.
    """
    mean_of = lambda key: F.avg(F.when(F.col(group) == F.lit(key), F.col(value)))
    gap = F.abs(F.col("first_mean") - F.col("second_mean"))
    return (
        df.where(F.col(group).isin(first, second))
        .agg(mean_of(first).alias("first_mean"), mean_of(second).alias("second_mean"))
        .withColumn("gap", gap)
        .withColumn(
            "verdict",
            F.when(F.col("gap") < limit, rules.SMALL_GAP_VERDICT).when(
                F.col("gap") >= limit, rules.LARGE_GAP_VERDICT
            ),
        )
    )
