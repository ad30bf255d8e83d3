"""Bounded samples of labelled rows, for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_ids(labels: DataFrame, label: str, most: int, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``label`` of at most ``most`` documents, one row each.

    The sample is fixed by a hash of the id, so reruns agree. Rows without an
    id or label are passed over; of several labels of one id the largest
    counts. The row limit is what makes the result safe to broadcast.
    """
    rows = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
