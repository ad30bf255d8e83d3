"""Merkle manifest of a dataset, with the proof of every row by pointer jumping.

Rows are leaves, in order within their group. Runs of neighbours are hashed
into a node until one is left, the root of the group; roots of groups, in
order, are hashed into the root of the dataset the same way.

Every node below the root starts with a pointer to its parent and one segment:
the digests of the others of its run, left and right. A round joins the nodes
with themselves where their pointers lead and concatenates the segments, so
the distance doubles, and after as many rounds as the logarithm of the height
every leaf points to the root and holds its whole proof.

Only digests are sorted and shuffled. Places in order come from a sort by
range: rows count themselves within their part of it, and parts add up what is
before them, so a group with any share of the rows is never one task. Many
pointers lead to one node only high above the leaves, where nodes are few: if
they fit a stated size, by their number, they are broadcast, and their pointers
are not gathered. What reached the root takes no further part.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import written

FANOUT = 3
#: Segments of all nodes that a round points to, if they are to be broadcast.
BROADCAST_BYTES = 8 << 20
#: Bytes a node takes beside its segments, and each segment, about.
NODE_BYTES, SEGMENT_BYTES = 64, 128
#: Bits of a monotonic id that count rows within a partition.
_ROW_BITS = 33
NODE = ["tree", "level", "at"]
#: The tree above all groups. Groups are named "" for null, else with a stroke before.
TOP = "top"


def digest(text: Column) -> Column:
    """The sha256 of a string's UTF-8 bytes, in lower-case hexadecimal digits."""
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, ``-`` for null."""
    told = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(told).cast("string"), F.lit(":"), told), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(F.concat(*map(field, values)))


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with ``at``, their place in the group from 0, and ``held``, its number of rows.

    Nulls come first. Rows equal in ``order`` follow each other as they are
    read, so that a row repeated without end is dealt out like any others.
    """
    rows = rows.withColumn("read", F.monotonically_increasing_id())
    keys = [F.col(k).asc_nulls_first() for k in (group, *order, "read")]
    in_order = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("read")
    numbered = written(in_order.withColumn("place", F.monotonically_increasing_id()), "manifest_order")
    numbered = numbered.withColumn("part", F.shiftright("place", _ROW_BITS))
    bounds = numbered.groupBy(group, "part").agg(F.min("place").alias("least"), F.count("*").alias("rows"))
    # One row per group and part of the sort, so a window holds as many as there are parts.
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bounds = bounds.select(
        group, "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("least")).alias("shift"),
        F.sum("rows").over(Window.partitionBy(group)).alias("held"),
    )
    joined = numbered.join(bounds, [group, "part"])
    return joined.withColumn("at", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def _climb(level: DataFrame, fanout: int) -> DataFrame:
    """The nodes above a level's, with the digests of their children in order."""
    above = level.where("held > 1").groupBy("tree", F.floor(F.col("at") / fanout).alias("at")).agg(
        F.first("level").alias("level"), F.first("held").alias("held"),
        F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("children"),
    )
    children = F.transform("children", lambda c: c["digest"])
    return above.select(
        "tree", (F.col("level") + 1).alias("level"), "at", F.ceil(F.col("held") / fanout).alias("held"),
        digest(F.array_join(children, "")).alias("digest"), children.alias("children"),
    )


def trees(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of all trees, from ``tree``, ``at``, ``held``, ``digest`` of their leaves.

    A level has the nodes that are left of every tree, each with the digests of
    its ``children``. A run has ``fanout`` rows at most, whatever a tree holds.
    """
    none = F.lit(None).cast("array<string>").alias("children")
    found = [leaves.select("tree", F.lit(0).alias("level"), "at", "held", "digest", none)]
    most = leaves.agg(F.max("held")).first()[0] or 0
    while most > 1:
        found.append(written(_climb(found[-1], fanout), f"manifest_level{len(found)}"))
        most = -(-most // fanout)
    return found


def _together(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _pointers(levels: list[DataFrame], fanout: int) -> list[DataFrame]:
    """Per level, every node that has a parent: its id, its parent's, and one segment."""
    found = []
    for above in levels[1:]:
        rows = above.select("tree", "level", "at", F.posexplode("children").alias("place", "own"), "children")
        side = lambda start, length: F.unhex(F.array_join(F.slice("children", start, length), ""))
        left = side(F.lit(1), F.col("place"))
        right = side(F.col("place") + 2, F.size("children") - F.col("place") - 1)
        found.append(rows.select(
            "tree", (F.col("level") - 1).alias("level"), (F.col("at") * fanout + F.col("place")).alias("at"),
            F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("at").alias("up_at"),
            F.array(F.struct(left.alias("left"), right.alias("right"))).alias("segments"),
        ))
    return found


def _proofs(nodes: DataFrame, root: tuple, rounds: int) -> DataFrame:
    """``tree``, ``at``, ``segments`` up to the root, of every leaf below the top tree."""
    at_root = F.lit(True)
    for name, value in zip(NODE, root):
        at_root = at_root & (F.col(f"up_{name}") == F.lit(value))
    is_leaf = (F.col("tree") != TOP) & (F.col("level") == 0)
    nodes = written(nodes, "manifest_nodes")
    # How many nodes there are from a level on, to know what a round points to.
    sizes = nodes.groupBy("level", (F.col("tree") == TOP).alias("top")).count().collect()
    done, moving = [nodes.where(at_root)], nodes.where(~at_root)
    for step in range(rounds):
        reach = 1 << step
        met = (F.col("tree") == TOP) | (F.col("level") >= reach)
        on = _together([moving, *done]).where(met).select(
            *[F.col(n).alias(f"on_{n}") for n in NODE], *[F.col(f"up_{n}").alias(f"on_up_{n}") for n in NODE],
            F.col("segments").alias("on_segments"),
        )
        rows = sum(r["count"] for r in sizes if r["top"] or r["level"] >= reach)
        if rows * (NODE_BYTES + SEGMENT_BYTES * reach) <= BROADCAST_BYTES:
            on = F.broadcast(on)
        joined = moving.join(on, reduce(and_, [F.col(f"up_{n}") == F.col(f"on_{n}") for n in NODE]))
        joined = joined.select(
            *NODE, *[F.col(f"on_up_{n}").alias(f"up_{n}") for n in NODE], F.concat("segments", "on_segments").alias("segments")
        )
        # Leaves, and what later rounds point to.
        joined = joined.where(is_leaf | (F.col("tree") == TOP) | (F.col("level") >= 2 * reach))
        if step < rounds - 1:
            joined = written(joined, f"manifest_jump{step}")
        done.append(joined.where(at_root))
        moving = joined.where(~at_root)
    return _together(done).where(is_leaf).select("tree", "at", "segments")


def manifest(
    docs: DataFrame, fields: list[str], order: str = "doc_id", group: str = "source", fanout: int = FANOUT,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: ``order``, the columns of ``also``, ``leaf``, ``subroot``, ``root``, ``segments``.

    ``leaf`` is the digest of ``fields``, each with its length in bytes before
    it, ``subroot`` that of the row's group, ``root`` that of the dataset.
    ``segments`` is the proof: for every level from leaf to root the digests of
    the others of the run, those on the left and those on the right.

    A null field counts as ``-``, empty text has length 0. Null is a group of
    its own, before all others; groups go by the bytes of their names. Rows go
    by ``order``, nulls first, and by leaf where that is equal. Each copy of a
    row is a leaf. A group of one row has its leaf as subroot, a single group
    its subroot as root. No rows give no rows. Columns not named are not looked at.
    """
    name = F.coalesce(F.concat(F.lit("/"), F.col(group).cast("string")), F.lit(""))
    rows = docs.select(
        F.col(order).alias("row_order"), name.alias("tree"), leaf([F.col(f) for f in fields]).alias("digest"),
        *[c.alias(f"also_{n}") for n, c in (also or {}).items()],
    )
    leaves = written(ranked(rows, "tree", ["row_order", "digest"]), "manifest_leaves")
    levels = trees(leaves, fanout)
    subroots = _together([v.where("held = 1") for v in levels]).select("tree", "level", "digest")
    subroots = subroots.withColumn("top", F.lit(TOP))
    tops = written(ranked(subroots, "top", ["tree"]), "manifest_tops")
    top_levels = trees(tops.select(F.col("top").alias("tree"), "at", "held", "digest"), fanout)
    root = top_levels[-1].first()
    # The root of a group is a leaf of the top tree: nothing stands beside it.
    links = tops.select(
        "tree", "level", F.lit(0).cast("bigint").alias("at"), F.col("top").alias("up_tree"), F.lit(0).alias("up_level"),
        F.col("at").alias("up_at"), F.array().cast("array<struct<left:binary,right:binary>>").alias("segments"),
    )
    nodes = _together([*_pointers(levels, fanout), *_pointers(top_levels, fanout), links])
    height = len(levels) + len(top_levels) - 1
    proofs = _proofs(nodes, (TOP, len(top_levels) - 1, 0), (height - 1).bit_length())
    found = leaves.join(proofs, ["tree", "at"]).join(tops.select("tree", F.col("digest").alias("subroot")), "tree")
    return found.select(
        F.col("row_order").alias(order), *[F.col(f"also_{n}").alias(n) for n in also or {}], F.col("digest").alias("leaf"),
        "subroot", F.lit(root["digest"] if root else None).cast("string").alias("root"), "segments",
    )


def _digits(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def proof_text(segments: Column) -> Column:
    """The digests of a proof one after the other, level by level, left before right."""
    return F.array_join(F.transform(segments, lambda s: F.concat(_digits(s["left"]), _digits(s["right"]))), "")


def folded(start: Column, segments: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(segments, start, lambda so_far, s: digest(F.concat(_digits(s["left"]), so_far, _digits(s["right"]))))
