"""Toxicity by a linear classifier over character n-grams with naive Bayes scaling.

The features of a text are the character n-grams of its distinct words, hashed
into buckets; a feature's value is the number of distinct words that have it,
over a power of the number of distinct words, times its naive Bayes log-count
ratio between both labels. Words are runs of letters, so that marks put between
or behind them change nothing. Logistic regression over the scaled features is
fitted on a bounded sample of labelled rows. A part of the sample is first kept
back to find where scores part the labels best, and the constant is moved
there. As features add up word by word, a worker scores each word once and
remembers it.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from tallywork.llm.common import text_or_empty
from tallywork.llm.memo import Memo
from tallywork.llm.samples import labelled_ids

SIZES = (4, 5)
BUCKETS = 1 << 17
FOLDS, HELD_OUT_FOLD = 5, 0
#: Labelled rows to fit on, at most.
SAMPLE_ROWS = 6_000
SMOOTHING = 1.0
RIDGE = 1e-5
ROUNDS, RATE = 100, 0.1
#: What sums over the distinct words of a text are divided by: this power of their number.
POWER = 0.6
#: One in so many rows of the sample is kept back for the limit between labels.
INNER_FOLDS = 4
#: Letters of a word at most: longer runs of letters are several words.
WORD_LETTERS = 64
#: Bytes a worker takes to remember scores of words, about.
MEMORY = 100_000_000

_WORD = re.compile(rf"[^\W\d_]{{1,{WORD_LETTERS}}}")


def words_of(text: str) -> set[str]:
    """The distinct words of a text in lower case."""
    return set(_WORD.findall(text.lower()))


def damped(n: int) -> float:
    return max(1, n) ** -POWER


def grams_of(word: str) -> list[int]:
    """The buckets of the n-grams of a word with its ends marked, each once."""
    marked = f"<{word}>"
    found = {marked[i : i + n] for n in SIZES for i in range(len(marked) - n + 1)}
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in found] or [0]


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels are kept from learning; a null id's are."""
    fold = F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS
    return fold == HELD_OUT_FOLD


class Model:
    """A weight per bucket and a constant."""

    def __init__(self, weights: np.ndarray, constant: float):
        self.weights, self.constant = weights, constant
        self.known = Memo(self._scores, MEMORY)

    def __getstate__(self):
        return self.weights, self.constant

    def __setstate__(self, state):
        self.__init__(*state)

    def _scores(self, words: list[str]) -> list[float]:
        return [float(self.weights[grams_of(w)].sum()) for w in words]

    def log_odds(self, words: set[str]) -> float:
        known = self.known
        # In order, so that sums do not depend on the order of a set.
        return self.constant + sum([known[w] for w in sorted(words)]) * damped(len(words))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.log_odds(words_of(text)), -35, 35))))


def fit_words(texts: Iterable[set[str]], labels: np.ndarray) -> Model:
    """Fits on sets of words; without both labels, their smoothed share alone.

    Words and n-grams are held as flat arrays of numbers, texts one at a time.
    """
    share = (labels.sum() + 1) / (len(labels) + 2)
    if not 0 < labels.sum() < len(labels):
        return Model(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    numbers: dict[str, int] = {}
    words, sizes = array("i"), []
    for text in texts:
        words.extend(numbers.setdefault(w, len(numbers)) for w in sorted(text))
        sizes.append(len(text))
    word_at, doc_at = np.array(words), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    grams, counts = array("i"), []
    for word in numbers:
        own = grams_of(word)
        grams.extend(own)
        counts.append(len(own))
    gram_at, gram_word = np.array(grams), np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    del words, grams

    def by_bucket(per_word: np.ndarray) -> np.ndarray:
        return np.bincount(gram_at, per_word[gram_word], BUCKETS)

    def by_word(per_doc: np.ndarray) -> np.ndarray:
        return np.bincount(word_at, per_doc[doc_at], len(numbers))

    yes, no = (SMOOTHING + by_bucket(by_word(labels == side)) for side in (1, 0))
    ratio = np.log(yes / yes.sum()) - np.log(no / no.sum())
    # Both labels weigh in by the root of their share, so that the rarer one is heard.
    weigh = np.where(labels == 1, np.sqrt((1 - share) / share), 1.0)
    weigh /= weigh.sum()
    scale = np.array([damped(n) for n in sizes])
    w, b = np.zeros(BUCKETS), 0.0
    mean, spread, mean_b, spread_b = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0
    for t in range(1, ROUNDS + 1):
        per_word = np.bincount(gram_word, (ratio * w)[gram_at], len(numbers))
        z = b + scale * np.bincount(doc_at, per_word[word_at], len(labels))
        slope = weigh * (1 / (1 + np.exp(-np.clip(z, -35, 35))) - labels)
        g = ratio * by_bucket(by_word(slope * scale)) + RIDGE * w
        g_b = slope.sum()
        mean, spread = 0.9 * mean + 0.1 * g, 0.99 * spread + 0.01 * g * g
        mean_b, spread_b = 0.9 * mean_b + 0.1 * g_b, 0.99 * spread_b + 0.01 * g_b * g_b
        rate = RATE * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w -= rate * mean / (np.sqrt(spread) + 1e-8)
        b -= rate * mean_b / (np.sqrt(spread_b) + 1e-8)
    return Model(ratio * w, float(b))


def best_limit(odds: np.ndarray, labels: np.ndarray) -> float:
    """Where log-odds part the labels best, by the F1 of the rarer one, label 1.

    Between two neighbouring rows any limit parts alike: 0 is taken if it lies
    there, else the middle. Of equally good gaps the one nearest to 0 counts.
    """
    order = np.argsort(-odds, kind="stable")
    odds, labels = odds[order], labels[order]
    hit, taken = np.cumsum(labels), np.arange(1, len(labels) + 1)
    f1 = 2 * hit / (taken + labels.sum())
    below = np.r_[odds[1:], odds[-1] - 1]
    # Rows of equal odds cannot be parted.
    f1 = np.where(below < odds, f1, -1)
    limit = np.where((below < 0) & (odds >= 0), 0, (odds + below) / 2)
    best = np.flatnonzero(f1 == f1.max())
    return float(limit[best[np.argmin(np.abs(limit[best]))]])


def fit_limited(texts: list[str], labels: np.ndarray, inner: np.ndarray) -> Model:
    """Fits on all texts, given as their words; rows marked ``inner`` set the limit.

    These are left out of a first fit and scored by it. Without both labels on
    either side the limit stays at 0.
    """
    sets = lambda rows: (set(texts[i].split(" ")) - {""} for i in rows)
    limit = 0.0
    sides = labels[inner], labels[~inner]
    if all(0 < side.sum() < len(side) for side in sides):
        first = fit_words(sets(np.flatnonzero(~inner)), sides[1])
        limit = best_limit(np.array([first.log_odds(w) for w in sets(np.flatnonzero(inner))]), sides[0])
    model = fit_words(sets(range(len(texts))), labels)
    model.constant -= limit
    return model


def _word_lists(texts: pd.Series) -> pd.Series:
    return pd.Series([" ".join(sorted(words_of(t))) for t in texts])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", most: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``most`` labelled rows outside the held-out fold.

    The driver gets the distinct words of these texts.
    """
    ids = labelled_ids(labels.where(~held_out(F.col("doc_id"))), label, most)
    sample = F.broadcast(ids.withColumnRenamed("doc_id", "sample_id"))
    rows = docs.select(F.col(doc_id).alias("id"), text_or_empty(F.col(text)).alias("text"))
    rows = rows.join(sample, rows["id"] == sample["sample_id"])
    listed = F.pandas_udf(_word_lists, StringType())("text").alias("words")
    # Where ids repeat there may be more rows than ids: a hash of the row picks.
    rows = rows.select("id", listed, "label").orderBy(F.xxhash64("id", "words"), "id", "words").limit(most).toPandas()
    rows = rows.sort_values(["id", "words"])
    inner = np.array([zlib.crc32(f"inner {i}".encode()) % INNER_FOLDS == 0 for i in rows["id"]], bool)
    return fit_limited(rows["words"].tolist(), rows["label"].to_numpy(np.float64), inner)


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Null and empty texts and texts without letters have no features and get
    the model's constant. Texts and words of any length are read whole. Null
    ids count as held out. Without labels of both kinds the score is their
    smoothed share for all. Copies of a row get the same score. No rows give
    no rows. Other columns are not looked at.
    """
    model = fit(docs, labels, doc_id, text)

    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    score = F.pandas_udf(scores, DoubleType())(text_or_empty(F.col(text)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
