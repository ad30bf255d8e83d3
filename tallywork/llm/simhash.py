"""Near-duplicates by SimHash, found by ball hashing that meets in the middle.

Two fingerprints at most four bits apart have a value in common that is at
most two bits away from either. So every distinct fingerprint emits all its
variants within two bits, 2,081 of them, and fingerprints that emit the same
variant are candidates.

The shuffle on variants does not ship them one by one. The 64 bits are dealt
out in turn to ``groups`` groups, and the parities of the groups form the
bucket of a value. A variant lies in a bucket that differs from that of its
fingerprint in at most two parities, so a fingerprint is sent once to each of
these buckets, and the bucket's task spells out the variants that fall into
it. Flipping any bit changes the bucket, so a dense group of near copies
spreads over the buckets, and a variant is shared by 2,081 fingerprints at
most, however many copies there are. The number of groups follows the number
of fingerprints, which only sets how much one task holds.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallywork.llm.common import LOWER, UPPER, text_or_empty, written
from tallywork.llm.components import connected

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
BITS = 64
#: Variants that one bucket holds, about: 8 bytes each.
BUCKET_VARIANTS = 2_000_000

_TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint_of(text: str | None) -> int:
    """The fingerprint of one text as a signed 64-bit number; no words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TO_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(SHINGLE_WORDS, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for part in np.array_split(hashes, -(-n // 65_536)):
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")


def fingerprint(text: Column) -> Column:
    return F.pandas_udf(_fingerprints, LongType())(text.cast("string"))


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _group_masks(groups: int) -> list[int]:
    return [sum(1 << b for b in range(g, BITS, groups)) for g in range(groups)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _bucket(value: Column, groups: int) -> Column:
    code = F.lit(0)
    for g, mask in enumerate(_group_masks(groups)):
        parity = F.bit_count(value.bitwiseAND(F.lit(_signed(mask)))) % 2
        code = code + F.shiftleft(parity, g)
    return code


def _steps(groups: int, reach: int) -> list[int]:
    """How the bucket of a variant can differ from that of its fingerprint."""
    flips = [sum(1 << g for g in c) for r in range(reach + 1) for c in combinations(range(groups), r)]
    return sorted(set(flips))


def _flips_by_step(groups: int, reach: int) -> dict[int, np.ndarray]:
    """The flips of up to ``reach`` bits, by the step they make."""
    found: dict[int, list[int]] = {}
    for r in range(reach + 1):
        for bits in combinations(range(BITS), r):
            step = 0
            for b in bits:
                step ^= 1 << (b % groups)
            found.setdefault(step, []).append(sum(1 << b for b in bits))
    return {step: np.array(flips, np.uint64) for step, flips in found.items()}


def groups_for(fingerprints: int, reach: int) -> int:
    """Parity groups for buckets of about ``BUCKET_VARIANTS`` variants."""
    ball = sum(math.comb(BITS, r) for r in range(reach + 1))
    wanted = math.ceil(math.log2(max(2, fingerprints * ball / BUCKET_VARIANTS)))
    return min(max(wanted, 4), 30)


def _roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component, by repeated halving."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def bucket_links(groups: int, radius: int):
    """The task of one bucket: its links as (fingerprint, root) rows."""
    flips = _flips_by_step(groups, radius // 2)

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["fp"].to_numpy().astype(np.uint64)
        steps = rows["step"].to_numpy()
        variants, owners = [], []
        for step in np.unique(steps):
            at = np.flatnonzero(steps == step)
            masks = flips[int(step)]
            variants.append((own[at][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(at, len(masks)))
        variant, owner = np.concatenate(variants), np.concatenate(owners)
        order = np.lexsort((own[owner], variant))
        variant, owner = variant[order], owner[order]
        # Members of a run share a variant; each is linked to the run's first.
        begins = np.flatnonzero(np.r_[True, variant[1:] != variant[:-1]])
        sizes = np.diff(np.r_[begins, len(variant)])
        first = np.repeat(owner[begins], sizes)
        linked = first != owner
        pairs = np.unique(np.stack([first[linked], owner[linked]]), axis=1)
        apart = np.bitwise_count(own[pairs[0]] ^ own[pairs[1]])
        pairs = pairs[:, apart <= radius]
        root = _roots(len(own), pairs[0], pairs[1])
        moved = np.flatnonzero(root != np.arange(len(own)))
        return pd.DataFrame({"a": own[moved].astype(np.int64), "b": own[root[moved]].astype(np.int64)})

    return links


def fingerprint_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a``, ``b``: links that join all fingerprints ``fp`` within ``radius`` bits.

    Only links that are needed to connect a component are kept, so a dense
    group gives a number of rows that grows with its size, not its square.
    """
    count = fps.count()
    groups = groups_for(count, radius // 2)
    # As many tasks as there are buckets for, up to a bucket or two each.
    parts = max(1, min(1 << groups, math.ceil(count * len(_steps(groups, radius // 2)) / 100_000)))
    step = F.explode(F.array(*[F.lit(s) for s in _steps(groups, radius // 2)])).alias("step")
    sent = fps.select("fp", _bucket(F.col("fp"), groups).alias("own"), step)
    sent = sent.select("fp", "step", F.col("own").bitwiseXOR(F.col("step")).alias("bucket"))
    sent = sent.repartition(parts, "bucket")
    links = sent.groupBy("bucket").applyInPandas(bucket_links(groups, radius), "a bigint, b bigint")
    return links.distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``key_text``, ``fp``, ``component_id`` for every row.

    Rows are in one component if a chain of fingerprints at most four bits
    apart joins them; ``component_id`` is the smallest id in it.

    Null and empty texts, and texts of blanks, have fingerprint 0 and are
    linked like any other. Null ids are never the smallest; a component of
    null ids only has a null ``component_id``. Rows with one id stay separate
    rows. No rows give no rows. Other columns are not looked at.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text_or_empty(F.col(text))).alias("key_text"),
        fingerprint(F.col(text)).alias("fp"),
    )
    rows = written(rows, "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    labels = connected(written(fingerprint_links(fps), "fingerprint_links"))
    roots = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    roots = roots.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = written(roots, "fingerprint_roots")
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    members = written(roots.select("fp", "root").join(least, "root"), "fingerprint_components")
    # A hot fingerprint is a hot key of this join; adaptive execution splits it.
    return rows.join(members.select("fp", "root", "component_id"), "fp").select(
        "doc_id", "key_text", "fp", "root", "component_id"
    )


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs``; of each component the row with the smallest id.

    Of rows that share this id, the one with the smallest text hash stays, and
    of rows equal in both the smallest by all their columns, in order; these
    must have an order. A null id stays only in a component of null ids. Null
    and empty texts are one component. No rows give no rows.
    """
    found = near_duplicates(docs, doc_id, text)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key_text")
    stays = found.groupBy("root").agg(F.min(order).alias("first"))
    # Keys without nulls, by which rows are joined and grouped in one shuffle.
    key = lambda own_id: [own_id.isNull().alias("no_id"), F.coalesce(own_id.cast("string"), F.lit("")).alias("own_id")]
    stays = stays.select(*key(F.col("first.doc_id")), "first.key_text").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    rows = rows.select("row", *key(F.col(f"row.{doc_id}")), F.xxhash64(text_or_empty(F.col(f"row.{text}"))).alias("key_text"))
    names = ["no_id", "own_id", "key_text"]
    kept = rows.join(stays, names).groupBy(*names).agg(F.min("row").alias("row"))
    return kept.select("row.*")
