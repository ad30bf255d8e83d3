"""Readers for persisted counts, in the TSV and the tuple form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions import rules
from tallywork.sources.text import read_lines

FORMS = ("tsv", "tuple")
# Runs without blanks, as ranges: threads of one JVM match those faster than a negated class.
_FIELDS = r"[\x00-\x08\x0E-\x1F\x21-\x{10FFFF}]+"
_BLANKS = " \t\n\x0b\f\r"
_LINE_ENDS = r"[\n\r\x{85}\x{2028}\x{2029}]"
_COUNT = rf"^(?:{rules.COUNT_PATTERN})\z"


def _checked(form: str) -> str:
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}, not {form!r}")
    return form


def _tsv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``key`` and ``count`` of lines with exactly two fields, in lower case."""
    lines = read_lines(spark, paths).select(F.lower("value").alias("value"))
    starts = ~F.substring("value", 1, 1).rlike(r"\s")
    # A generator keeps later filters from taking the line apart once more.
    fields = lines.where(starts).select(F.explode(F.array(F.regexp_extract_all("value", F.lit(_FIELDS), F.lit(0)))).alias("fields"))
    return fields.where(F.size("fields") == 2).select(F.get("fields", F.lit(0)).alias("key"), F.get("fields", F.lit(1)).alias("count"))


def _tuple(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``key`` and ``count`` of lines in brackets; the last comma separates them, so the key may hold others."""
    lines = read_lines(spark, paths, recursive=True)
    lines = lines.where(F.startswith("value", F.lit("(")) & F.endswith("value", F.lit(")")) & F.contains("value", F.lit(",")))
    length, count = F.length("value"), F.substring_index("value", ",", -1)
    key = F.substr("value", F.lit(2), length - F.length(count) - 2)
    blank_free = F.trim(F.substr(count, F.lit(1), F.length(count) - 1), F.lit(_BLANKS))
    return lines.select(key.alias("key"), blank_free.alias("count"))


def _counted(rows: DataFrame, keys: list[Column]) -> DataFrame:
    rows = rows.where(F.col("count").rlike(_COUNT))
    # Well-formed, but beyond 64 bits, is dropped as well.
    rows = rows.select(*keys, F.col("count").try_cast("bigint").alias("cnt"))
    return rows.where(F.col("cnt").isNotNull())


def read_token_counts(
    spark: SparkSession, paths: str | Sequence[str], form: str = "tsv"
) -> DataFrame:
    """``token``, ``cnt``. Lines that do not fit the form are dropped."""
    if _checked(form) == "tsv":
        rows = _tsv(spark, paths)
    else:
        rows = _tuple(spark, paths).where(~F.col("key").rlike(_LINE_ENDS))
    return _counted(rows, [F.col("key").alias("token")])


def read_pair_counts(
    spark: SparkSession, paths: str | Sequence[str], form: str = "tsv"
) -> DataFrame:
    """``left``, ``right``, ``cnt``. Lines that do not fit the form are dropped.

    The key has one separator. Its right side is never empty, its left side
    only in the tuple form; blanks around the key do not count there.
    """
    rows = _tsv(spark, paths) if _checked(form) == "tsv" else _tuple(spark, paths)
    left = F.substring_index("key", rules.PAIR_SEPARATOR, 1)
    right = F.substring_index("key", rules.PAIR_SEPARATOR, -1)
    rows = rows.where(F.length(left) + F.length(right) + 1 == F.length("key"))
    if form == "tuple":
        left, right = F.ltrim(left, F.lit(_BLANKS)), F.rtrim(right, F.lit(_BLANKS))
    else:
        rows = rows.where(left != "")
    return _counted(rows.where(right != ""), [left.alias("left"), right.alias("right")])
