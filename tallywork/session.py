"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024
SHUFFLE_PARTITION_BYTES = 256 * MIB
SPLIT_MIB = 128
#: A number of partitions to deal texts out to before they are tokenized; unset,
#: texts stay in the splits they are read in.
TEXT_PARTITIONS = "spark.tallywork.textPartitions"


def shuffle_partitions_for(shuffled_bytes: int, cores: int) -> int:
    """Enough partitions to keep each near 256 MiB, and at least one per core."""
    return max(cores, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))


def settings_for(
    input_bytes: int, cores: int, expansion: float = 1.0, split_mib: int = SPLIT_MIB
) -> dict[str, str]:
    """Settings to create a session with, for an input of about this size.

    ``expansion`` is what a job shuffles over what it reads: counts add up
    before the shuffle and stay below 1, pairs of an unseen vocabulary reach
    about 4. Larger splits keep the number of map tasks down; 512 MiB suits
    inputs of many terabytes.
    """
    shuffled = int(input_bytes * expansion)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(split_mib * MIB),
        "spark.sql.shuffle.partitions": str(shuffle_partitions_for(shuffled, cores)),
        "spark.sql.session.timeZone": "UTC",
    }


def local_session(cores: int | str = 8, input_bytes: int = 0, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and timing runs."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tallywork")
    builder = builder.config("spark.driver.memory", memory).config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    builder = builder.config(TEXT_PARTITIONS, cores if str(cores).isdigit() else 8)
    count = int(cores) if str(cores).isdigit() else 8
    for key, value in settings_for(input_bytes, count).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def text_partitions(spark: SparkSession) -> int | None:
    """The session's setting for dealing out texts."""
    wanted = spark.conf.get(TEXT_PARTITIONS, None)
    return int(wanted) if wanted else None


#: Of text whose pairs are counted, a task takes at most this much. Distinct pairs
#: take about 14 times their text in memory, and a task that must spill them
#: takes much longer.
COUNTED_MIB = 16
MAX_SPLIT = "spark.sql.files.maxPartitionBytes"


def sibling_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session with the settings of this one but for these; this one stays as it is."""
    sibling = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    return sibling


def with_small_splits(spark: SparkSession, settings: dict[str, str] | None = None) -> SparkSession:
    """A sibling that reads splits of at most ``COUNTED_MIB``, with these settings as well."""
    number, unit = re.match(r"(\d+)([kmgt]?)", spark.conf.get(MAX_SPLIT).lower()).groups()
    size = int(number) << 10 * " kmgt".index(unit or " ")
    return sibling_with(spark, {**(settings or {}), MAX_SPLIT: str(min(size, COUNTED_MIB * MIB))})


def in_small_splits(spark: SparkSession, read: Callable[[SparkSession], DataFrame]) -> DataFrame:
    """The rows that ``read`` reads, in splits of at most ``COUNTED_MIB``.

    The size of splits is a setting of the session that reads, so a sibling
    with the same settings but that one reads. The session stays as it is,
    and what it gets is its own.
    """
    return read(spark).limit(0).union(read(with_small_splits(spark)))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names.

    Without that setting, a folder in the session's warehouse, which the
    driver and all executors share as well. Never a temporary folder of one
    machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str) -> tuple:
    """A path and its own file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table by the rules of its own file system."""
    place, system = _place(spark, path)
    system.delete(place, True)
