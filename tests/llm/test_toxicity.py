import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallywork.llm import toxicity
from tests.llm import tables

RUDE = ["blockhead", "nitwit", "dimwit"]


def corpus(n=600):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        text, rude = tables.prose(rng, rng.randint(5, 200)), rng.random() < 0.25
        if rude:
            words = text.split()
            for _ in range(1 + len(words) // 40):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE))
            text = " ".join(words)
        rows.append(tables.row(i, text))
        labels.append((i, 1, int(rude)))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = corpus()
    got = toxicity.classify(tables.documents(spark, rows), spark.createDataFrame(labels, tables.LABELS)).collect()
    truth = {i: toxic for i, _, toxic in labels}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    wrong = [r.doc_id for r in held if r.predicted != truth[r.doc_id]]
    assert len(wrong) <= 0.05 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_labels_of_the_held_out_fold_are_never_learnt(spark):
    rows, labels = corpus(200)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    docs = tables.documents(spark, rows)
    first, second = (tables.values(toxicity.classify(docs, spark.createDataFrame(x, tables.LABELS))) for x in (labels, flipped))
    assert first == second


def test_scores_add_up_from_the_grams_of_distinct_words():
    rows, labels = corpus(100)
    model = toxicity.fit_words([toxicity.words_of(r[1]) for r in rows], np.array([t for _, _, t in labels], float))
    text = rows[3][1]
    words = {w for w in "".join(c if c.isalpha() else " " for c in text.lower()).split()}
    z = model.constant + sum(model.weights[g] for w in words for g in toxicity.grams_of(w)) / len(words) ** toxicity.POWER
    assert abs(model.score(text) - 1 / (1 + np.exp(-z))) < 1e-9


def test_fit_equals_a_plain_fit():
    """The same descent over a dense matrix of n-gram counts per text."""
    rows, labels = corpus(60)
    y = np.array([t for _, _, t in labels], float)
    words = [toxicity.words_of(r[1]) for r in rows]
    grams = sorted({g for text in words for w in text for g in toxicity.grams_of(w)})
    at = {g: i for i, g in enumerate(grams)}
    counts = np.zeros((len(rows), len(grams)))
    for i, text in enumerate(words):
        for w in text:
            for g in toxicity.grams_of(w):
                counts[i, at[g]] += 1
    yes, no = (counts[y == side].sum(axis=0) + toxicity.SMOOTHING for side in (1, 0))
    # Buckets that no text has count as well.
    unseen = toxicity.SMOOTHING * (toxicity.BUCKETS - len(grams))
    ratio = np.log(yes / (yes.sum() + unseen)) - np.log(no / (no.sum() + unseen))
    x = counts * ratio / np.array([len(t) for t in words])[:, None] ** toxicity.POWER
    share = (y.sum() + 1) / (len(y) + 2)
    weigh = np.where(y == 1, np.sqrt((1 - share) / share), 1)
    weigh /= weigh.sum()
    theta, mean, spread = np.zeros(len(grams) + 1), 0, 0
    for t in range(1, toxicity.ROUNDS + 1):
        slope = weigh * (1 / (1 + np.exp(-(x @ theta[:-1] + theta[-1]))) - y)
        g = np.r_[slope @ x + toxicity.RIDGE * theta[:-1], slope.sum()]
        mean, spread = 0.9 * mean + 0.1 * g, 0.99 * spread + 0.01 * g * g
        theta = theta - toxicity.RATE * (mean / (1 - 0.9**t)) / (np.sqrt(spread / (1 - 0.99**t)) + 1e-8)
    model = toxicity.fit_words(words, y)
    got = np.array([model.log_odds(w) for w in words])
    assert np.allclose(got, x @ theta[:-1] + theta[-1], atol=0.05)


def test_limit_is_the_best_of_all():
    rng = random.Random(4)
    for n in (2, 5, 40):
        odds = np.array([round(rng.gauss(-1, 2), 1) for _ in range(n)])
        labels = np.array([1.0, 0.0] + [float(rng.random() < 0.4) for _ in range(n - 2)])
        f1 = lambda limit: 2 * labels[odds >= limit].sum() / ((odds >= limit).sum() + labels.sum())  # noqa: E731, B023
        best = max(f1(v) for v in odds)
        assert abs(f1(toxicity.best_limit(odds, labels)) - best) < 1e-12
    assert toxicity.best_limit(np.array([3.0, 2.0, -2.0]), np.array([1.0, 1.0, 0.0])) == 0.0


def test_long_words_are_read_whole_and_not_remembered(spark):
    rows, labels = corpus(300)
    docs = tables.documents(spark, [*rows, tables.row(9000, "x" * 1_000_000), tables.row(9001, "ab1" * 400_000 + " " + RUDE[0])])
    got = {r.doc_id: r for r in toxicity.classify(docs, spark.createDataFrame(labels, tables.LABELS)).collect()}
    assert got[9000].predicted == 0 and got[9001].score > got[9000].score
    assert max(map(len, toxicity.words_of("y" * 1000 + "z"))) == toxicity.WORD_LETTERS


def test_odd_tables(spark):
    docs = tables.clashing(tables.documents(spark, tables.ODD))
    none = spark.createDataFrame([], tables.LABELS)
    got = toxicity.classify(docs, none)
    assert {r.score for r in got.collect()} == {0.5} and got.count() == len(tables.ODD)
    assert [r.held_out for r in got.where(F.col("doc_id").isNull()).collect()] == [True, True]
    assert toxicity.classify(docs.limit(0), none).isEmpty()
