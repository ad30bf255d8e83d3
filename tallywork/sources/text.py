"""Line-oriented text corpora."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.functions import rules
from tallywork.session import in_small_splits


def _path_list(paths: str | Sequence[str]) -> list[str]:
    names = paths.split(",") if isinstance(paths, str) else paths
    return [name.strip() for name in names]


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], recursive: bool = False
) -> DataFrame:
    """Lines of one or more paths (a list, or one comma-separated string).

    Lines end at LF, CR or CRLF. Files in nested directories are read only if
    ``recursive`` is set.
    """
    return spark.read.option("recursiveFileLookup", recursive).text(_path_list(paths))


def _source_of(spark: SparkSession, file: Column, base: str) -> Column:
    """The directory directly below ``base`` that holds the file.

    The base is made fully qualified by the rules of its own file system, and
    stripped from the start of the file's path only.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = system.makeQualified(path).toUri()
    place = f"//{uri.getRawAuthority()}" if uri.getRawAuthority() else "(?://)?"
    start = rf"^{uri.getScheme()}:{place}\Q{uri.getRawPath().rstrip('/')}\E/"
    name = F.regexp_extract(file, rf"{start}([^/]+)/", 1)
    # File paths come with special characters percent-encoded; "+" stands for itself.
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    strange = F.raise_error(F.concat(F.lit(f"not below {base}: "), file)).cast("string")
    return F.when(name == "", strange).when(name.contains("%"), decoded).otherwise(name)


def read_sources(
    spark: SparkSession, base: str, sources: Sequence[str], recursive: bool = True
) -> DataFrame:
    """Lines of the chosen sub-directories of a corpus as ``value``, ``source``.

    Only the chosen directories are listed and read, in splits small enough
    for their pairs to be counted in memory.
    """
    base = base.rstrip("/")
    source = _source_of(spark, F.col("_metadata.file_path"), base)
    paths = [f"{base}/{name}" for name in sources]
    return in_small_splits(
        spark, lambda session: read_lines(session, paths, recursive).select("value", source.alias("source"))
    )


def split_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """One row per line of a text column; the line is ``value``, null gives no row."""
    others = [name for name in documents.columns if name != text]
    lines = F.explode(F.split(text, rules.LINE_END_PATTERN, -1)).alias("value")
    return documents.select(*others, lines)


def dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    """The rows dealt out to a number of partitions, or as they are for None.

    Tokenizing is CPU-bound, so a small file in one split keeps one core busy.
    Whether that is worth a shuffle of text is the caller's choice; at scale a
    scan has splits enough and should be left alone.
    """
    return df.repartition(partitions) if partitions else df
