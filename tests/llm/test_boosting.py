import random
import re
from collections import Counter

import numpy as np

from tallywork.llm import boosting
from tests.llm import tables


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    marked = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(marked)


def test_base_counts_equal_a_plain_model():
    rng = random.Random(6)
    texts = [None, "", " ", "a", "a a a", "a a a a", "b c d e b c d", "#é*$ %&|<>\n#é*$ %&|<>\n\n\n \n", "x\x1cy\x85z\xa0\x0b\x0cq", "w " * 50_000]
    texts += ["".join(rng.choice(["a ", "b ", "\n", "é", "| ", "c"]) for _ in range(rng.randint(1, 200))) for _ in range(300)]
    for text in texts:
        assert boosting.counts_of(text)[:5] == plain(text), repr(text)[:80]


def model():
    rng = np.random.default_rng(2)
    x = rng.random((3000, len(boosting.FEATURES)))
    odds = 3 - 8 * x[:, 0] + 4 * np.sin(9 * x[:, 4]) + 2 * np.sin(20 * x[:, 1])
    y = (rng.random(3000) < 1 / (1 + np.exp(-odds))).astype(float)
    signs = np.array([sign for _, sign in boosting.FEATURES])
    return boosting.fit(x, y, signs), x, y


def test_trees_learn_and_constrained_features_only_lower_the_score():
    forest, x, y = model()
    score = forest.score(x)
    assert score[y == 1].mean() - score[y == 0].mean() > 0.3
    for f, (_, sign) in enumerate(boosting.FEATURES):
        if sign:
            grid = np.repeat(x[:40], 60, axis=0)
            grid[:, f] = np.tile(np.linspace(0, 1, 60), 40)
            steps = np.diff(forest.score(grid).reshape(40, 60), axis=1) * sign
            assert steps.min() >= -1e-12


def test_flat_arrays_score_like_a_walk_from_the_root():
    forest, x, _ = model()
    for row, score in zip(x[:50], forest.score(x[:50])):
        z = forest.start
        for at in forest.roots:
            while forest.low[at] != at:
                at = forest.low[at] if row[forest.feature[at]] <= forest.limit[at] else forest.high[at]
            z += forest.value[at]
        assert abs(1 / (1 + np.exp(-z)) - score) < 1e-9


def junk(rng, n):
    return " ".join(rng.choice(tables.WORDS) + "***" for _ in range(n))


def test_verdicts_on_labelled_documents(spark):
    rng = random.Random(7)
    good = [tables.row(i, tables.prose(rng, rng.randint(60, 150))) for i in range(60)]
    bad = [tables.row(100 + i, junk(rng, rng.randint(60, 150))) for i in range(60)]
    labels = spark.createDataFrame([(r[0], int(r[0] < 100), None) for r in good + bad if r[0] % 2] + [(None, 1, 0), (7, None, None)], tables.LABELS)
    docs = tables.clashing(tables.documents(spark, good + bad + tables.ODD))
    got = boosting.judge(docs, labels).collect()
    assert len(got) == len(good + bad + tables.ODD)
    verdicts = {r.doc_id: r.kept for r in got if r.doc_id not in (None, 1, 2, 3, 4, 5, 6, 7)}
    assert all(verdicts[r[0]] for r in good if r[0] in verdicts) and not any(verdicts[r[0]] for r in bad)
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 50)


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], tables.LABELS)
    docs = tables.documents(spark, tables.ODD)
    assert {r.score for r in boosting.judge(docs, none).collect()} == {0.5}
    assert boosting.judge(docs.limit(0), none).isEmpty()


def test_the_bound_on_rows_of_repeated_ids_selects_by_no_count(spark, monkeypatch):
    rows = [(1, n) + (0,) * (len(boosting.COUNTS) - 1) for n in range(200)]
    counted = spark.createDataFrame(rows, "key_id bigint, " + ", ".join(f"{c} bigint" for c in ["n_words", *(c for c in boosting.COUNTS if c != "n_words")]))
    learnt = []
    monkeypatch.setattr(boosting, "features_of", lambda rows: learnt.append(rows))
    monkeypatch.setattr(boosting, "fit", lambda *_: None)
    boosting.fit_quality(counted, spark.createDataFrame([(1, 1, 0)], tables.LABELS), most=20)
    assert len(learnt[0]) == 20 and learnt[0]["n_words"].max() > 100
