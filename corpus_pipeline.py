"""The corpus pipeline: documents in, a training mix out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywork.llm import credentials, decontamination, mixing, resampling, simhash
from tallywork.llm.common import keep_last, scratch_tables, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_sampled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling rejects go.

    Null, empty and blank texts have log-weight 0 and stay; null ids are
    scored, copies of a row stay or go together, ties at the last key stay.
    Other columns are kept as they are; no rows give no rows.
    """
    return resampling.sampled_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays.

    It is the one with the smallest id, null ids last, then with the smallest
    text hash, then smallest by all columns; copies of it go. Null, empty and
    blank texts have fingerprint zero and form a group with all that is linked
    to it. Other columns stay with their row; no rows give no rows.
    """
    return simhash.one_per_group(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go.

    Null and empty texts hold none and stay, whatever their ids; copies of a
    row go together. Without items all stay. Other columns are kept as they
    are; no rows give no rows.
    """
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; no document goes.

    ``n_chars`` follows the text. Null and empty texts and texts without
    secrets stay as they are, as do null ids and all other columns; copies of
    a row change alike. No rows give no rows.
    """
    return credentials.redacted(docs, length="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes, with the number of ``copies`` of each document.

    Null and empty texts have size 0 and null is a source of its own, the last
    one. Rows equal in id, text and source are taken alike. A column named
    ``copies`` is replaced, the others are kept; no rows give no rows.
    """
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_sampled),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scan", hide_secrets),
    ("source_mixing", mix_sources),
]

#: Trained models and iterated groups are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again as the next one's input.

    Once a stage is written, its input and its own scratch tables are removed:
    what is left at the end is one table.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch_tables() as tables:
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
            keep_last(spark, tables)
    return docs
