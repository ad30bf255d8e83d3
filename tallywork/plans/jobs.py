"""The corpus jobs over text files, singly and for a growing series of sources.

A corpus is a directory with one sub-directory of text files per source.
Outputs are laid out as ``<out>/job=<job>/range=<first>-<last>``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions import rules
from tallywork.operators import counts, prefix, select, tokens
from tallywork.session import remove_path, scratch_path
from tallywork.sinks import (
    layout_path,
    write_by_range,
    write_counts,
    write_spans_by_range,
    write_top,
)
from tallywork.sources import dealt, read_pair_counts, read_sources, read_token_counts


class CountJob(NamedTuple):
    rows: Callable[[DataFrame], DataFrame]
    count: Callable[[DataFrame], DataFrame]
    read: Callable[..., DataFrame]
    spans: Callable[..., DataFrame]


class SelectJob(NamedTuple):
    parent: str
    select: Callable[[DataFrame, int], DataFrame]
    by_step: Callable[[DataFrame, int], DataFrame]
    is_top: bool


COUNT_JOBS = {
    "token_counts": CountJob(
        tokens.explode_tokens, counts.count_tokens, read_token_counts, prefix.token_spans
    ),
    "pair_counts": CountJob(
        tokens.explode_pairs, counts.count_pairs, read_pair_counts, prefix.pair_spans
    ),
}
SELECT_JOBS = {
    "words_with_count": SelectJob(
        "token_counts", select.words_with_count, prefix.prefix_words_with_count, False
    ),
    "word_pairs_with_count": SelectJob(
        "pair_counts", select.word_pairs_with_count, prefix.prefix_word_pairs_with_count, False
    ),
    "top_words": SelectJob("token_counts", select.top_words, prefix.prefix_top_words, True),
    "top_number_word_pairs": SelectJob(
        "pair_counts", select.top_number_word_pairs, prefix.prefix_top_number_word_pairs, True
    ),
}


def run_count_job(
    spark: SparkSession,
    job: str,
    corpus: str,
    sources: Sequence[str],
    out: str,
    form: str = "tsv",
    partitions: int | None = None,
) -> str:
    """Count the tokens or pairs of the chosen sources; returns the output path.

    ``partitions`` deals out the lines first, for a corpus of a few small files.
    """
    lines = dealt(read_sources(spark, corpus, sources).select("value"), partitions)
    path = layout_path(out, job, sources)
    write_counts(COUNT_JOBS[job].count(COUNT_JOBS[job].rows(lines)), path, form)
    return path


def run_select_job(
    spark: SparkSession,
    job: str,
    sources: Sequence[str],
    out: str,
    form: str = "tsv",
    limit: int | None = None,
) -> str:
    """Select from the written output of the parent job; returns the output path.

    ``limit`` is the count wanted, or the length of a top list.
    """
    step = SELECT_JOBS[job]
    parent = COUNT_JOBS[step.parent].read(spark, layout_path(out, step.parent, sources), form)
    path = layout_path(out, job, sources)
    wanted = _limit_of(step, limit)
    if step.is_top:
        write_top(step.select(parent, wanted), path, form, k=wanted)
    else:
        write_counts(step.select(parent, wanted), path, form)
    return path


def run_series(
    spark: SparkSession,
    corpus: str,
    sources: Sequence[str],
    out: str,
    form: str = "tsv",
    n: int = rules.COUNT_WANTED,
    k: int = rules.TOP_K,
    partitions: int | None = None,
    compression: str | None = None,
) -> None:
    """All six jobs for the first source, the first two, and so on to all of them.

    The corpus is read once per kind of count, not once per step. The counts
    by span are written to the scratch folder, and the three outputs of a kind
    are made from that table, so a lost executor never sends a later output
    back to the text. The tables are deleted once all outputs are written.
    """
    names = F.array(*[F.lit(name) for name in sources])
    place = F.array_position(names, F.col("source")).cast("int")
    unknown = F.raise_error(F.concat(F.lit("not in the series: "), F.col("source")))
    step = F.when(place > 0, place - 1).otherwise(unknown.cast("int")).alias("step")
    lines = dealt(read_sources(spark, corpus, sources).select("value", step), partitions)
    for parent, count_job in COUNT_JOBS.items():
        kept = scratch_path(spark, f"{parent}_spans")
        count_job.spans(count_job.rows(lines), len(sources) - 1).write.parquet(kept)
        spans = spark.read.parquet(kept)
        how = {"sources": sources, "form": form, "compression": compression}
        write_spans_by_range(spark, kept, f"{out}/job={parent}", **how)
        for name, job in SELECT_JOBS.items():
            if job.parent == parent:
                rows = job.by_step(spans, k if job.is_top else n)
                write_by_range(rows, f"{out}/job={name}", top=job.is_top, **how)
        remove_path(spark, kept)


def _limit_of(job: SelectJob, limit: int | None) -> int:
    if limit is not None:
        return limit
    return rules.TOP_K if job.is_top else rules.COUNT_WANTED
