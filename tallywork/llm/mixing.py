"""Mixing sources to target weights by hash thresholds.

Every document has a fixed point on a line of ``POINT_BITS`` bits, its hash.
A source whose target is r times its size plus a rest takes r copies of every
document and one more of those whose point lies below a threshold. The
threshold is found by histograms: sizes are summed by source and by the
leading bits of the point, running sums find the bucket in which the rest is
used up, and only the documents of that bucket are looked at again with the
next bits. The last bucket is one point; its documents are taken if that lands
nearer to the target than leaving them. Nothing is sorted but sums of buckets,
and a larger budget always takes a superset of the documents of a smaller one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import null_safe_join, text_or_empty, word_count, written

POINT_BITS = 60
BITS_PER_LEVEL = 12
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3


def point(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of a digest of id and text: the same in every run."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    digest = F.md5(F.concat(name, F.lit("|"), text_or_empty(text)))
    return F.conv(F.substring(digest, 1, POINT_BITS // 4), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row per source.

    Sources in code point order, null last, have the weights in turn. Sharing
    out what goes beyond ``most`` times a source's size again and again ends
    where every source gets the same amount per unit of weight or its limit.
    Sources reach their limit in the order of limit by weight, so running
    sums in that order give the amount at once. The window holds one row per
    source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = sizes.select("source", "source_size", turn.alias("weight"))
    rows = rows.withColumn("limit", (F.col("source_size") * most).cast("double"))
    everything = Window.partitionBy(F.lit(0))
    by_limit = Window.partitionBy(F.lit(0)).orderBy(
        F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    limited = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    freed = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # What each unit of weight gets if all sources before this one are at
    # their limit and none after it is.
    total = F.sum("source_size").over(everything).cast("double")
    rows = rows.withColumn("unit", (total - limited) / (F.sum("weight").over(everything) - freed))
    # The first source that does not reach its limit settles the amount.
    fits = F.when(F.col("unit") * F.col("weight") <= F.col("limit"), F.col("unit"))
    rows = rows.withColumn("amount", F.first(fits, ignorenulls=True).over(
        by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    share = F.least(F.col("amount") * F.col("weight"), F.col("limit"))
    return rows.select("source", "source_size", F.coalesce(share, F.col("limit")).alias("target"))


def _thresholds(items: DataFrame, rests: DataFrame) -> DataFrame:
    """``source``, ``threshold``: points below it come nearest to ``rest``.

    ``rests`` has one row per source. A level turns the bucket in which the
    budget runs out into its own buckets; after the last level a bucket is one
    point. Each level sums in the map tasks first, so a hot source is one row
    per bucket and task.
    """
    state = rests.select("source", "rest", F.lit(0).cast("bigint").alias("used"), F.lit(0).cast("bigint").alias("lead"))
    for level in range(1, POINT_BITS // BITS_PER_LEVEL + 1):
        width = POINT_BITS - level * BITS_PER_LEVEL
        seen = items.select(
            "source", "size",
            F.shiftright("point", width + BITS_PER_LEVEL).alias("lead"),
            F.shiftright("point", width).alias("bucket"),
        )
        if level > 1:
            # Only the documents of the boundary buckets.
            edge = state.select("source", "lead")
            seen = null_safe_join(seen, edge, ["source", "lead"], "left_semi")
        sums = seen.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
        up_to = Window.partitionBy("source").orderBy("bucket")
        sums = sums.select("source", "bucket", F.sum("held").over(up_to).alias("reached"), "held")
        joined = null_safe_join(state.select("source", "rest", "used"), sums, ["source"], "left")
        over = F.col("used") + F.col("reached") > F.col("rest")
        before = (F.col("used") + F.col("reached") - F.col("held")).alias("used")
        state = joined.groupBy("source", "rest").agg(
            F.min(F.when(over, F.struct("bucket", before, "held"))).alias("edge"),
        ).select(
            "source", "rest", F.col("edge.used").alias("used"), F.col("edge.bucket").alias("lead"),
            F.col("edge.held").alias("held"),
        )
        state = written(state, f"mix_level{level}")
    nearer = F.col("used") + F.col("held") - F.col("rest") < F.col("rest") - F.col("used")
    return state.select("source", (F.col("lead") + nearer.cast("bigint")).alias("threshold"))


def _items(rows: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return rows.select(
        "*",
        F.col(doc_id).alias("mix_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        point(F.col(doc_id), F.col(text)).alias("point"),
    )


def _limits(items: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row per source: ``target``, whole copies, and the threshold of one more."""
    sizes = items.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = targets(sizes, weights, most).withColumn("whole", whole.cast("bigint"))
    goals = goals.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    goals = written(goals, "mix_targets")
    return written(null_safe_join(goals, _thresholds(items, goals), ["source"], "left"), "mix_limits")


def _copies() -> Column:
    # No threshold: the whole source fits into the rest, so all are taken.
    extra = F.when(F.col("rest") <= 0, 0).when(F.col("threshold").isNull(), 1)
    extra = extra.when(F.col("point") < F.col("threshold"), 1).otherwise(0)
    return (F.col("whole") + extra).cast("bigint")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``copies``.

    ``copies`` is how often the mix holds the document, ``taken`` is that many
    times its size. What a source's documents have taken differs from its
    target by at most half the words of one point: a document, or all rows of
    the source that are equal in id and text.

    Null texts have size 0. Null is a source of its own, the last one. A null
    id counts as an empty string for the hash. Rows equal in id and text share
    a point: of one source, all of them are taken or none. A source without
    words has target 0 and takes nothing. No rows give no rows. Other columns
    are not looked at.
    """
    rows = docs.select(
        F.col(doc_id).alias("in_id"), F.col(text).alias("in_text"), F.col(source).alias("in_source")
    )
    items = _items(rows, "in_id", "in_text", "in_source")
    items = written(items.select("mix_id", "source", "size", "point"), "mix_items")
    joined = null_safe_join(items, _limits(items, weights, most), ["source"], "left")
    return joined.select(
        F.col("mix_id").alias("doc_id"), "size", "source_size", "target",
        (_copies() * F.col("size")).alias("taken"), _copies().alias("copies"),
    )


def mixed_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """The columns of ``docs`` and ``copies``, for the documents the mix holds.

    An input column named ``copies`` is replaced. Cases as for ``mix``. Texts
    are not shuffled if the table of sources is small enough to be broadcast,
    which Spark decides by its size.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    items = _items(rows, f"row.{doc_id}", f"row.{text}", f"row.{source}")
    light = written(items.select("source", "size", "point"), "mix_items")
    joined = null_safe_join(items, _limits(light, weights, most), ["source"], "left")
    joined = joined.withColumn("in_mix", _copies()).where(F.col("in_mix") > 0)
    kept = [F.col(f"row.{c}").alias(c) for c in docs.columns if c != "copies"]
    return joined.select(*kept, F.col("in_mix").alias("copies"))
