"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.session import remove_path, scratch_path

# Everything but blank, tab, line feed, vertical tab, form feed and carriage
# return. Spelled out as ranges: threads of one JVM match it faster so.
WORD_PATTERN = r"[\x00-\x08\x0E-\x1F\x21-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_tables: ContextVar[list[str] | None] = ContextVar("tables", default=None)


@contextmanager
def scratch_tables() -> Iterator[list[str]]:
    """The paths of the tables that ``written`` makes inside, in order."""
    paths: list[str] = []
    token = _tables.set(paths)
    try:
        yield paths
    finally:
        _tables.reset(token)


def keep_last(spark: SparkSession, paths: list[str]) -> None:
    """Removes all of these tables but the last, once nothing else reads them."""
    while len(paths) > 1:
        remove_path(spark, paths.pop(0))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared scratch folder.

    Later steps read the table, so a lost executor never sends them back to
    the steps before it, and rows that depend on it see the same values.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    paths = _tables.get()
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_PATTERN)).cast("bigint")


def row_key(doc_id: str, text: str) -> list[Column]:
    """What tells rows apart: ``key_id`` and a hash of the text.

    Rows that agree in both are copies of one row and get the same results.
    """
    return [F.col(doc_id).alias("key_id"), F.xxhash64(text_or_empty(F.col(text))).alias("key_text")]


#: Bits that ``maybe_among`` broadcasts, whatever they stand for: 8 MB.
FILTER_BITS = 1 << 26


def maybe_among(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The rows with ``maybe``: false only if their 64-bit ``name`` is not one of the ``keys``.

    Keys set bits in a table of fixed size, which is broadcast, so rows are
    not shuffled to find out. Of ``n`` keys, other rows hit one by chance with
    ``n / FILTER_BITS`` at most. Nulls are among no keys. The rows have no
    columns ``bits``, ``bits_of`` or ``place``.
    """
    place = (F.pmod(F.col(name), F.lit(FILTER_BITS)) + 1).alias("place")
    bits = keys.select(place).groupBy(F.bitmap_bucket_number("place").alias("bits_of"))
    bits = written(bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")), f"{name}_bits")
    placed = rows.withColumn("place", place)
    at = F.bitmap_bit_position("place")
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = placed.join(F.broadcast(bits), F.bitmap_bucket_number("place") == F.col("bits_of"), "left")
    maybe = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return found.withColumn("maybe", maybe).drop("place", "bits_of", "bits")


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equality in which a null equals a null."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def null_safe_join(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """A join on columns of the same name, once in the result; nulls match."""
    renamed = right.withColumnsRenamed({n: f"right_{n}" for n in names})
    on = reduce(lambda a, b: a & b, [left[n].eqNullSafe(renamed[f"right_{n}"]) for n in names])
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"right_{n}" for n in names])
