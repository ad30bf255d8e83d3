"""Quality rules: gradient-boosted trees over document statistics.

Statistics are taken from each whole text once. The trees are fitted on a
bounded sample of labelled rows, with a sign constraint on features whose
effect is known, and flattened into plain node arrays; a batch of documents
walks all trees at once, one array step per level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from tallywork.llm.common import row_key, written
from tallywork.llm.samples import labelled_ids

# What the base rules count and where they fail.
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 3
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50
BLANKS = " \t\n\v\f\r"

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_distinct", "n_same_as_last",
)
#: Feature and the sign of its effect on quality: -1 falls, 1 rises, 0 free.
FEATURES = (
    ("symbol_share", -1), ("dup_line_share", -1), ("repeat_share", -1), ("upper_share", -1),
    ("digit_share", 0), ("distinct_share", 0), ("same_share", -1), ("word_length", 0),
    ("words_per_line", 0), ("n_words", 0),
)
#: Labelled rows to fit on, at most.
SAMPLE_ROWS = 20_000
TREES, DEPTH, RATE, BINS, RIDGE, LEAST_ROWS = 40, 3, 0.3, 32, 1.0, 5
KEEP_FROM = 0.5


def repeat_words(words: list) -> int:
    """Words in windows of three words that occur twice or more in the text."""
    n = len(words) - REPEAT_WINDOW + 1
    if n < 2:
        return 0
    seen: dict = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    window = codes[:n]
    for shift in range(1, REPEAT_WINDOW):
        # Renumbering after each word keeps the combined code small.
        pair = window * len(seen) + codes[shift : shift + n]
        window = np.unique(pair, return_inverse=True)[1]
    often = np.bincount(window)[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(REPEAT_WINDOW):
        covered[shift : shift + n] |= often
    return int(covered.sum())


def dup_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line; lines in all."""
    lines = text.split("\n")
    worded = [line for line in lines if line.strip(BLANKS)]
    return len(worded) - len(set(worded)), len(lines)


def counts_of(text: str | None) -> tuple[int, ...]:
    """The counts named in ``COUNTS``, of one text; null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    dups, lines = dup_lines(text)
    bytes_of = np.frombuffer(raw, np.uint8)
    per_byte = np.bincount(bytes_of, minlength=256)
    return (
        len(words),
        len(text) - int(sum(per_byte[ord(c)] for c in BLANKS)),
        int(sum(per_byte[ord(c)] for c in SYMBOLS)),
        dups,
        repeat_words(words),
        lines,
        int(per_byte[65:91].sum()),
        int(per_byte[48:58].sum()),
        len(set(words)),
        sum(map(bytes.__eq__, words[1:], words)),
    )


def _count_columns(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([counts_of(t) for t in texts], columns=list(COUNTS), dtype="int64")


def counts(text: Column) -> Column:
    shape = StructType([StructField(name, LongType()) for name in COUNTS])
    return F.pandas_udf(_count_columns, shape)(text.cast("string"))


def features_of(rows: pd.DataFrame) -> np.ndarray:
    """One column per feature, from the counts; shares of nothing are 0."""
    c = {name: rows[name].to_numpy(np.float64) for name in COUNTS}
    words, chars, lines = (np.maximum(c[n], 1) for n in ("n_words", "word_chars", "n_lines"))
    columns = {
        "symbol_share": c["n_symbols"] / chars, "dup_line_share": c["n_dup_lines"] / lines,
        "repeat_share": c["n_repeat_words"] / words, "upper_share": c["n_upper"] / chars,
        "digit_share": c["n_digits"] / chars, "distinct_share": c["n_distinct"] / words,
        "same_share": c["n_same_as_last"] / words, "word_length": c["word_chars"] / words,
        "words_per_line": c["n_words"] / lines, "n_words": c["n_words"],
    }
    return np.stack([columns[name] for name, _ in FEATURES], axis=1)


@dataclass
class Forest:
    """All trees in one set of arrays; a leaf is its own child on both sides."""

    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        if not len(self.roots):
            return np.full(len(x), _sigmoid(np.array(self.start)))
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_low = x[rows, self.feature[at]] <= self.limit[at]
            at = np.where(goes_low, self.low[at], self.high[at])
        return _sigmoid(self.start + self.value[at].sum(axis=1))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class _Grower:
    """Grows one tree after the other into shared node lists."""

    def __init__(self, x: np.ndarray, signs: np.ndarray):
        shares = np.linspace(0, 1, BINS + 1)[1:-1]
        self.limits = [np.unique(np.quantile(column, shares)) for column in x.T]
        self.bins = np.stack([np.searchsorted(l, c) for l, c in zip(self.limits, x.T)], axis=1)
        self.signs = signs
        self.nodes: list[list] = []

    def best(self, rows, slope, curve, floor, roof):
        """The split with the most gain whose children respect sign and bounds."""
        best = None
        g, h = slope[rows].sum(), curve[rows].sum()
        for f, limits in enumerate(self.limits):
            bins = self.bins[rows, f]
            gl = np.cumsum(np.bincount(bins, slope[rows], len(limits) + 1))[:-1]
            hl = np.cumsum(np.bincount(bins, curve[rows], len(limits) + 1))[:-1]
            nl = np.cumsum(np.bincount(bins, minlength=len(limits) + 1))[:-1]
            if not len(limits):
                continue
            left = np.clip(-gl / (hl + RIDGE), floor, roof)
            right = np.clip(-(g - gl) / (h - hl + RIDGE), floor, roof)
            gain = -(gl * left + 0.5 * (hl + RIDGE) * left**2)
            gain -= (g - gl) * right + 0.5 * (h - hl + RIDGE) * right**2
            allowed = (nl >= LEAST_ROWS) & (len(rows) - nl >= LEAST_ROWS)
            allowed &= self.signs[f] * (right - left) >= 0
            gain = np.where(allowed, gain, -np.inf)
            k = int(np.argmax(gain))
            if np.isfinite(gain[k]) and (best is None or gain[k] > best[0]):
                best = (gain[k], f, k, left[k], right[k])
        return best

    def grow(self, rows, slope, curve, depth, floor=-np.inf, roof=np.inf) -> int:
        me = len(self.nodes)
        g, h = slope[rows].sum(), curve[rows].sum()
        value = float(np.clip(-g / (h + RIDGE), floor, roof))
        self.nodes.append([0, 0.0, me, me, RATE * value])
        plain = -(g * value + 0.5 * (h + RIDGE) * value**2)
        found = self.best(rows, slope, curve, floor, roof) if depth else None
        if found is None or found[0] <= plain + 1e-9:
            return me
        _, f, k, left, right = found
        low = self.bins[rows, f] <= k
        # Below a constrained split no leaf may cross the middle of the two.
        middle = (left + right) / 2
        bounds = {0: ((floor, roof), (floor, roof)), 1: ((floor, middle), (middle, roof)), -1: ((middle, roof), (floor, middle))}
        of_low, of_high = bounds[int(self.signs[f])]
        a = self.grow(rows[low], slope, curve, depth - 1, *of_low)
        b = self.grow(rows[~low], slope, curve, depth - 1, *of_high)
        self.nodes[me][:4] = [f, float(self.limits[f][k]), a, b]
        return me


def fit(x: np.ndarray, y: np.ndarray, signs: np.ndarray) -> Forest:
    """Trees for the log-odds of y; without both labels, their share alone."""
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    roots, grower = [], None
    if 0 < y.sum() < len(y):
        grower = _Grower(x, signs)
        z = np.full(len(y), start)
        for _ in range(TREES):
            p = _sigmoid(z)
            first = len(grower.nodes)
            roots.append(grower.grow(np.arange(len(y)), p - y, p * (1 - p), DEPTH))
            tree = _flat(grower.nodes, [first], 0.0)
            z = z + tree.value[_leaves(tree, x)[:, 0]]
    return _flat(grower.nodes if grower else [], roots, start)


def _leaves(forest: Forest, x: np.ndarray) -> np.ndarray:
    at = np.tile(forest.roots, (len(x), 1))
    for _ in range(forest.depth):
        goes_low = x[np.arange(len(x))[:, None], forest.feature[at]] <= forest.limit[at]
        at = np.where(goes_low, forest.low[at], forest.high[at])
    return at


def _flat(nodes: list[list], roots: list[int], start: float) -> Forest:
    feature, limit, low, high, value = (list(c) for c in zip(*nodes)) if nodes else ([], [], [], [], [])
    whole = lambda c: np.array(c, np.int64)
    return Forest(whole(roots), whole(feature), np.array(limit, float), whole(low), whole(high), np.array(value, float), start, DEPTH)


def fit_quality(counted: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE_ROWS) -> Forest:
    """A forest from at most ``most`` labelled rows of a table of counts.

    The driver gets the counts of these rows, ten numbers each, not texts.
    """
    sample = F.broadcast(labelled_ids(labels, label, most))
    rows = counted.join(sample, counted["key_id"] == sample["doc_id"]).select("key_id", *COUNTS, "label")
    # Where ids repeat there may be more rows than ids: a hash of the row picks.
    order = [*COUNTS, "label"]
    rows = rows.orderBy(F.xxhash64("key_id", *COUNTS), *order).limit(most).select(*order).toPandas().sort_values(order)
    signs = np.array([sign for _, sign in FEATURES])
    return fit(features_of(rows), rows["label"].to_numpy(np.float64), signs)


def judge(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_from: float = KEEP_FROM
) -> DataFrame:
    """Per row: ``doc_id``, the counts, ``base_failed``, ``score``, ``kept``.

    ``kept`` needs the base rules passed and a score of ``keep_from`` or more.

    Null and empty texts have counts 0 and fail the base rules. Null ids are
    scored like others but never learnt from. Without labels of both kinds the
    score is their smoothed share for all (one half without any). Copies of a
    row are judged alike. No rows give no rows. Other columns are not looked
    at.
    """
    rows = docs.select(*row_key(doc_id, text), counts(F.col(text)).alias("counts"))
    counted = written(rows.select("key_id", "counts.*"), "quality_counts")
    forest = fit_quality(counted, labels)

    def scores(*columns: pd.Series) -> pd.Series:
        return pd.Series(forest.score(features_of(pd.concat(columns, axis=1, keys=COUNTS))))

    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words")
    )
    scored = counted.withColumn("score", F.pandas_udf(scores, DoubleType())(*COUNTS))
    scored = scored.withColumn("base_failed", failed)
    kept = (~F.col("base_failed") & (F.col("score") >= keep_from)).cast(BooleanType())
    return scored.select(F.col("key_id").alias("doc_id"), *COUNTS, "base_failed", "score", kept.alias("kept"))
