"""A quality classifier by importance resampling.

Two generative models over hashed n-grams are counted: one of target text
(documents labelled as good) and one of the raw corpus. A document's weight is
the ratio of the two, and the sample is the k documents with the largest
log-weight plus Gumbel noise, which draws k documents without replacement in
proportion to their weights. Documents outside the sample are rejected.

Long texts would make the ratio all or nothing, so log-weights are those of a
typical stretch of ``STRETCH`` n-grams: the mean over the text, pulled to 0 by
``PRIOR`` neutral n-grams, times that length. k is stated by the caller, as a
number or a share of the rows; without either it is the number of documents
whose log-weight is at least ``REJECT_BELOW``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, DoubleType

from tallywork.llm.common import row_key, text_or_empty, written
from tallywork.llm.samples import labelled_ids

TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+|\n")
#: Hash buckets for words and pairs of words, and for runs of three shapes.
WORD_BUCKETS, SHAPE_BUCKETS = 8192, 4096
SHAPES = 16
SMOOTHING = 1.0
STRETCH, PRIOR, REJECT_BELOW = 100, 20, -20.0
#: Labelled rows that make up the target, at most.
SAMPLE_ROWS = 20_000
SEED = 5
#: Tokens a worker remembers the codes of, and characters of one at most; it
#: starts anew beyond that.
MEMORY, MEMORY_CHARS = 200_000, 64

_KIND_OF_SYMBOL = {c: 6 + i % 6 for i, c in enumerate("#*$%&|<>!?.,;:-")}


def shape_of(token: str) -> int:
    """A small number for the look of a token."""
    if token == "\n":
        return 1
    first = token[0]
    if first.isalnum():
        if first.isdigit():
            return 2
        if token.isupper() and len(token) > 1:
            return 3
        return 4 if first.isupper() else 5
    # The last character tells a run of marks from plain punctuation before it.
    return _KIND_OF_SYMBOL.get(token[-1], 12)


class Codes(dict):
    """Token to its hash and shape in one number. Long tokens are not kept."""

    def __missing__(self, token: str) -> int:
        code = zlib.crc32(token.lower().encode("utf-8", "surrogatepass")) << 4 | shape_of(token)
        if len(token) <= MEMORY_CHARS:
            if len(self) >= MEMORY:
                self.clear()
            self[token] = code
        return code


_codes = Codes()


def buckets_of(text: str | None) -> np.ndarray:
    """The buckets of all n-grams of a text: words, word pairs, shape triples."""
    code = np.array([_codes[t] for t in TOKEN.findall(text or "")], np.int64)
    if not len(code):
        return code
    word, shape = code >> 4, code & 15
    same = np.r_[False, word[1:] == word[:-1]]
    # A token that repeats the one before it has a shape of its own.
    shape = np.where(same & (shape > 1), 13 + (shape < 6), shape)
    pair = (word[1:] * 31 + word[:-1] * 1_000_003) % WORD_BUCKETS
    triple = shape.copy()
    triple[1:] += shape[:-1] * SHAPES
    triple[2:] += shape[:-2] * SHAPES * SHAPES
    return np.concatenate([word % WORD_BUCKETS, pair, WORD_BUCKETS + triple])


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts by bucket of all rows of a task, raw and target."""
    size = WORD_BUCKETS + SHAPE_BUCKETS
    raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for batch in batches:
        for text, is_target in zip(batch["text"], batch["is_target"]):
            seen = np.bincount(buckets_of(text), minlength=size)
            raw += seen
            if is_target:
                target += seen
    at = np.flatnonzero(raw)
    yield pd.DataFrame({"bucket": at, "raw": raw[at], "target": target[at]})


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most: int = SAMPLE_ROWS) -> np.ndarray:
    """The log ratio of target to raw by bucket.

    The raw model counts every document. The target model counts at most
    ``most`` documents labelled 1, whose ids are broadcast. The driver gets
    one row per bucket.
    """
    good = labelled_ids(labels.where(F.col(label) == 1), label, most)
    target = F.broadcast(good.select(F.col("doc_id").alias("target_id"), F.lit(True).alias("is_target")))
    rows = docs.select(F.col(doc_id).alias("id"), text_or_empty(F.col(text)).alias("text"))
    rows = rows.join(target, rows["id"] == target["target_id"], "left").select("text", "is_target")
    rows = rows.withColumn("is_target", F.coalesce("is_target", F.lit(False)))
    counted = rows.mapInPandas(_count, "bucket bigint, raw bigint, target bigint")
    sums = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    ratio = np.zeros(WORD_BUCKETS + SHAPE_BUCKETS)
    if not sums["target"].sum():
        return ratio
    for stream in (slice(0, WORD_BUCKETS), slice(WORD_BUCKETS, None)):
        raw, target = np.zeros(len(ratio)), np.zeros(len(ratio))
        raw[sums["bucket"]], target[sums["bucket"]] = sums["raw"], sums["target"]
        raw, target = raw[stream] + SMOOTHING, target[stream] + SMOOTHING
        ratio[stream] = np.log(target / target.sum()) - np.log(raw / raw.sum())
    return ratio


def weight(text: Column, ratio: np.ndarray) -> Column:
    """A struct of ``n_grams`` and ``log_weight`` of a text."""

    def weights(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            at = buckets_of(text)
            out.append((len(at), STRETCH * float(ratio[at].sum()) / (len(at) + PRIOR)))
        return pd.DataFrame(out, columns=["n_grams", "log_weight"]).astype({"n_grams": "int64", "log_weight": "float64"})

    shape = StructType([StructField("n_grams", LongType()), StructField("log_weight", DoubleType())])
    return F.pandas_udf(weights, shape)(text_or_empty(text))


def gumbel(seed: int | Column, *names: str) -> Column:
    """Gumbel noise fixed by a hash of the row: the same in every run."""
    bits = F.shiftrightunsigned(F.xxhash64(seed if isinstance(seed, Column) else F.lit(seed), *names), 11)
    return -F.log(-F.log((bits + 0.5) / float(1 << 53)))


def kth_largest(rows: DataFrame, name: str, k: int, buckets: int = 4096, rounds: int = 6) -> float:
    """A value that k rows reach; rows that tie with the k-th reach it too.

    Histograms over a range that shrinks to the bucket of the k-th row. The
    driver sees one row per bucket and round, and nothing is sorted.
    """
    ends = rows.agg(F.min(name).alias("low"), F.max(name).alias("high"), F.count("*").alias("n")).first()
    if k >= ends["n"] or not ends["n"]:
        return float("-inf")
    if k <= 0:
        return float("inf")
    low, high, above = float(ends["low"]), float(ends["high"]), 0
    for _ in range(rounds):
        width = (high - low) / buckets
        if width <= 0 or low + width == low:
            break
        place = F.least(F.floor((F.col(name) - low) / width), F.lit(buckets - 1))
        inside = rows.where((F.col(name) >= low) & (F.col(name) <= high))
        counts = dict(inside.groupBy(place.cast("int").alias("place")).count().collect())
        for at in sorted(counts, reverse=True):
            if above + counts[at] >= k:
                break
            above += counts[at]
        low, high = low + at * width, low + (at + 1) * width if at < buckets - 1 else high
        if above + counts[at] == k:
            break
    return low


def _scored(rows: DataFrame, ratio: np.ndarray, seed: int) -> DataFrame:
    rows = rows.withColumn("weight", weight(F.col("whole"), ratio))
    rows = rows.withColumns({"n_grams": F.col("weight.n_grams"), "log_weight": F.col("weight.log_weight")}).drop("weight")
    return rows.withColumn("gumbel_key", F.col("log_weight") + gumbel(seed, "key_id", "key_text"))


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(*row_key(doc_id, text), F.col(text).alias("whole"))


def _key_of_last(scored: DataFrame, size: int | None, share: float | None) -> float:
    if share is not None:
        size = round(scored.count() * share)
    if size is None:
        size = scored.where(F.col("log_weight") >= REJECT_BELOW).count()
    return kth_largest(scored, "gumbel_key", size)


def resample(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    size: int | None = None, share: float | None = None, seed: int = SEED,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_grams``, ``log_weight``, ``gumbel_key``, ``kept``.

    The sample has ``size`` rows, or ``share`` of all rows; without either as
    many as have a log-weight that is no sign of other text. It is drawn
    without replacement in proportion to the weights; ``seed`` fixes the draw.

    Null and empty texts have no n-grams and log-weight 0. Null ids are scored
    but never part of the target. Without documents labelled 1 all log-weights
    are 0 and all documents are kept. Copies of a row share their noise and
    are kept or rejected together, as are ties at the last key. No rows give
    no rows. Other columns are not looked at.
    """
    ratio = fit(docs, labels, doc_id, text)
    scored = _scored(_rows(docs, doc_id, text), ratio, seed)
    scored = written(scored.select("key_id", "n_grams", "log_weight", "gumbel_key"), "resampling_scores")
    kept = (F.col("gumbel_key") >= _key_of_last(scored, size, share)).alias("kept")
    return scored.select(F.col("key_id").alias("doc_id"), "n_grams", "log_weight", "gumbel_key", kept)


def sampled_documents(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    size: int | None = None, share: float | None = None, seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` that ``resample`` keeps, as they are.

    Rows are written next to their scores and filtered when read again, so
    that texts are scored once and never shuffled.

    Null and empty texts have log-weight 0; null ids are scored; copies of a
    row, and ties at the last key, stay or go together; no rows give no rows.
    All columns stay as they are, whatever their names.
    """
    ratio = fit(docs, labels, doc_id, text)
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    rows = rows.select("row", F.col(f"row.{doc_id}").alias("own_id"), F.col(f"row.{text}").alias("whole"))
    scored = _scored(rows.select("row", "whole", *row_key("own_id", "whole")), ratio, seed)
    scored = written(scored.select("row", "log_weight", "gumbel_key"), "resampling_scores")
    last_key = _key_of_last(scored, size, share)
    return scored.where(F.col("gumbel_key") >= last_key).select("row.*")
