"""Text sinks. An output that exists already is refused, never overwritten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions import pair_key, rules
from tallywork.session import path_exists, with_small_splits
from tallywork.sources.counts import FORMS

# What Spark's own partitioned writers encode in the name of a folder.
_ENCODED = {chr(c) for c in (*range(1, 32), 127)} | set("\"#%'*/:=?\\{[]^")


#: Steps of a series written by one job, and so the files that a task holds open.
STEPS_TOGETHER = 32

# No key holds the separator, and nothing is quoted. On lines in key order, level
# four of gzip makes files 3 % larger than its usual six, in a third of the time.
_AS_IT_IS = {
    "zlib.compress.level": "FOUR",
    "sep": "\x01", "quote": "", "emptyValue": "", "lineSep": "\n", "extension": "txt",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def key_of(counts: DataFrame) -> Column:
    """The rendered key of a token or pair count table."""
    if "token" in counts.columns:
        return F.col("token")
    return pair_key(F.col("left"), F.col("right"))


def render(key: Column, cnt: Column, form: str) -> Column:
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}, not {form!r}")
    if form == "tsv":
        return F.concat(key, F.lit("\t"), cnt.cast("string"))
    return F.concat(F.lit("("), key, F.lit(","), cnt.cast("string"), F.lit(")"))


def write_counts(counts: DataFrame, path: str, form: str = "tsv") -> None:
    """Write a count table, one part file per partition.

    The TSV form is ordered by key within each part. The tuple form promises
    no order. A large table is never drawn together into one file, as that
    would put the whole result through one task.
    """
    rows = counts.select(key_of(counts).alias("key"), "cnt")
    if form == "tsv":
        rows = rows.sortWithinPartitions("key")
    rows.select(render(F.col("key"), F.col("cnt"), form).alias("value")).write.mode(
        "errorifexists"
    ).text(path)


def write_top(
    top: DataFrame, path: str, form: str = "tsv", k: int | None = None
) -> None:
    """Write the first k rows of a top list as one file in rank order.

    Without k nothing is cut: a list of more than ``TOP_K`` rows is refused.
    """
    if k is None:
        k = rules.TOP_K
        if top.limit(k + 1).count() > k:
            raise ValueError(f"the list has more than {k} rows; name k")
    rows = top.select(key_of(top).alias("key"), "cnt").orderBy(F.desc("cnt"), "key").limit(k)
    rows.coalesce(1).sortWithinPartitions(F.desc("cnt"), "key").select(
        render(F.col("key"), F.col("cnt"), form).alias("value")
    ).write.mode("errorifexists").text(path)


def range_name(sources: Sequence[str]) -> str:
    """``first-last``; of a directory named ``column=value`` the value counts."""
    first, last = (name.rsplit("=", 1)[-1] for name in (sources[0], sources[-1]))
    return f"{first}-{last}"


def layout_path(base: str, job: str, sources: Sequence[str]) -> str:
    """Where the output of a job over an ordered list of sources belongs."""
    return f"{base.rstrip('/')}/job={job}/range={range_name(sources)}"


def write_by_range(
    steps: DataFrame,
    path: str,
    sources: Sequence[str],
    form: str = "tsv",
    top: bool = False,
    compression: str | None = None,
) -> None:
    """Write rows with a ``step`` into one ``range=`` directory per step.

    Step s covers the first s + 1 of the ordered sources. Rows go out in key
    order within each part. Top lists, which are small, go out as one plain
    file per range in rank order.
    """
    names = [F.lit(range_name(sources[: s + 1])) for s in range(len(sources))]
    rows = steps.select(
        F.get(F.array(*names), F.col("step")).alias("range"), key_of(steps).alias("key"), "cnt"
    )
    if top:
        rows = rows.repartition("range").sortWithinPartitions("range", F.desc("cnt"), "key")
    else:
        # By range first: else every task writes a file into every range.
        rows = rows.hint("rebalance", "range").sortWithinPartitions("range", "key")
    rows.select("range", render(F.col("key"), F.col("cnt"), form).alias("value")).write.mode(
        "errorifexists"
    ).partitionBy("range").text(path, compression=None if top else compression)


def write_spans_by_range(
    spark: SparkSession,
    spans: str,
    path: str,
    sources: Sequence[str],
    form: str = "tsv",
    compression: str | None = None,
) -> None:
    """Write the counts that a table of spans stands for into one ``range=`` directory per step.

    The directories and rows are those of ``write_by_range`` for the steps
    spelled out, and steps without rows have a directory as well. As spans
    cover up to all steps, those are many times their rows, and never shuffled
    or sorted here: spans are sorted and rendered once, and spelled out into
    one open file per step. Each ``STEPS_TOGETHER`` steps are a job that reads
    the spans, so that a task holds as many files open at most. Lines go
    through the CSV writer as its only column, as they are: it hands them to
    the compressor thousands of bytes at a time, the text writer line by line,
    which takes several times as long.
    """
    names = [range_name(sources[: s + 1]) for s in range(len(sources))]
    if path_exists(spark, path) or len(set(names)) < len(names):
        raise AnalysisException(f"{path} already exists, or one of its ranges")
    # With no files to hold open, Spark would sort all rows by range.
    sibling = with_small_splits(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(STEPS_TOGETHER)})
    rows = sibling.read.parquet(spans)
    rows = rows.select("first_step", "last_step", key_of(rows).alias("key"), "cnt")
    for begin in range(0, len(names), STEPS_TOGETHER):
        end = min(begin + STEPS_TOGETHER, len(names)) - 1
        held = rows.where((F.col("first_step") <= end) & (F.col("last_step") >= begin))
        held = held.where(F.col("first_step") <= F.col("last_step")).sortWithinPartitions("key")
        steps = F.sequence(F.greatest("first_step", F.lit(begin)), F.least("last_step", F.lit(end)))
        held = held.select(steps.alias("steps"), render(F.col("key"), F.col("cnt"), form).alias("value"))
        ranges = F.array(*[F.lit(name) for name in names])
        held.select(F.explode("steps").alias("step"), "value").select(
            F.get(ranges, F.col("step")).alias("range"), "value"
        ).write.mode("append").partitionBy("range").options(**_AS_IT_IS).csv(path, compression=compression)
    for name in names:
        folder = f"{path.rstrip('/')}/range=" + "".join(f"%{ord(c):02X}" if c in _ENCODED else c for c in name)
        if not path_exists(spark, folder):
            rows.select(F.lit("").alias("value")).limit(0).write.text(folder, compression=compression)

