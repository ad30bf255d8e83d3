"""Fixity audits of archive replicas by Merkle trees.

A replica is a table of records: the file, the offset and the digest of the
bytes, taken where the bytes are read, so that contents are never shuffled.
The digests of an offset range are hashed in order into the node of that
range, ranges are hashed into larger ranges, up to one root per file.
An audit compares the roots of two replicas and goes down only below nodes
that differ, so the digests of sound files are never compared one by one.

Trees are tables with one row per node, partitioned by level, and each step
down reads one level. Archives write them once per replica, next to the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import null_safe_join, text_or_empty, written
from tallywork.session import scratch_path

#: Bits of the offset that a node at each level spans: 64 KiB first, then 16
#: times as much per level. The last level is the whole file.
LEVEL_BITS = (16, 20, 24, 28, 32, 63)
ROOT = len(LEVEL_BITS)


def warc_record(uri: Column, record_id: Column, payload: Column) -> Column:
    """A response record as bytes: headers, a blank line, the payload and two line ends."""
    body = text_or_empty(payload)
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), text_or_empty(uri),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    ).cast("binary")


def record_digest(data: Column) -> Column:
    """The digest of a record's bytes; null counts as empty."""
    return F.sha2(F.coalesce(data.cast("binary"), F.lit("").cast("binary")), 256)


def hash_tree(records: DataFrame, file: str = "file", offset: str = "offset", digest: str = "digest") -> DataFrame:
    """``level``, ``file``, ``place``, ``digest``: level 0 has records by offset, ``ROOT`` the files.

    Several records at one offset count as one whose digest covers how many
    there are and what they are. A null digest counts as empty, a null offset
    as -1. A range holds at most as many records as it has bytes, and as a
    rule, with headers of a hundred bytes, a few hundred. No records give no
    nodes.
    """
    hashed = records.select(
        F.col(file).alias("file"), F.coalesce(F.col(offset), F.lit(-1)).cast("bigint").alias("place"),
        F.coalesce(F.col(digest), F.lit("")).alias("digest"),
    )
    # Numbers that do not depend on order describe the records at one offset.
    several = F.sha2(F.concat_ws(":", F.count("*"), F.min("digest"), F.max("digest"), F.sum(F.crc32("digest"))).cast("binary"), 256)
    nodes = hashed.groupBy("file", "place").agg(
        F.when(F.count("*") == 1, F.min("digest")).otherwise(several).alias("digest")
    )
    path, spark = scratch_path(records.sparkSession, "hash_tree"), records.sparkSession
    nodes.write.parquet(f"{path}/level=0")
    below = 0
    for level, bits in enumerate(LEVEL_BITS, start=1):
        nodes = spark.read.parquet(f"{path}/level={level - 1}")
        up = F.shiftright(F.col("place"), bits - below)
        ordered = F.array_sort(F.collect_list(F.struct("place", "digest")))
        joined = F.concat_ws(",", F.transform(ordered, lambda n: F.concat_ws(":", n["place"], n["digest"])))
        grown = nodes.groupBy("file", up.alias("place")).agg(F.sha2(joined.cast("binary"), 256).alias("digest"))
        grown.write.parquet(f"{path}/level={level}")
        below = bits
    return spark.read.parquet(path).select("level", "file", "place", "digest")


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """``file``, ``place`` and both digests where the two differ or one has none."""
    both = left.select("file", "place", F.col("digest").alias("expected"), F.lit(None).cast("string").alias("found"))
    both = both.unionByName(right.select("file", "place", F.lit(None).cast("string").alias("expected"), F.col("digest").alias("found")))
    met = both.groupBy("file", "place").agg(F.max("expected").alias("expected"), F.max("found").alias("found"))
    return met.where(~F.col("expected").eqNullSafe(F.col("found")))


def audit(master: DataFrame, replica: DataFrame) -> DataFrame:
    """``file``, ``offset``, ``status``, ``expected``, ``found`` of records that differ between two trees.

    ``status`` is ``changed``, ``missing`` (not in the replica) or ``extra``.
    Equal trees give no rows. A null file is a file of its own.
    """
    open_nodes = None
    for level in range(ROOT, -1, -1):
        sides = [tree.where(F.col("level") == level).select("file", "place", "digest") for tree in (master, replica)]
        if open_nodes is not None:
            bits = LEVEL_BITS[level] - (LEVEL_BITS[level - 1] if level else 0)
            sides = [side.withColumn("up", F.shiftright("place", bits)) for side in sides]
            above = open_nodes.select("file", F.col("place").alias("up"))
            sides = [null_safe_join(side, above, ["file", "up"], "left_semi") for side in sides]
        open_nodes = written(_differing(*sides), f"audit_level{level}")
    status = F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "extra").otherwise("changed")
    return open_nodes.select("file", F.col("place").alias("offset"), status.alias("status"), "expected", "found")
