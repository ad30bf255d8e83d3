import gc
import random

import numpy as np
import pytest

from tallywork.llm import decontamination as d
from tests.llm import tables


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            row[j + 1], before = max(row[j], row[j + 1], before + (x == y)), row[j + 1]
    return row[-1]


def test_lcs_equals_dynamic_programming():
    rng = random.Random(2)
    for _ in range(300):
        text = " ".join(rng.choice(tables.WORDS[:12]) for _ in range(rng.randint(1, 70)))
        item = d.Item(1, text)
        words = [int(c) for c in d.codes_of(" ".join(rng.choice(tables.WORDS[:20]) for _ in range(rng.randint(1, 90))))]
        assert round(item.in_order(words) * len(item.codes)) == plain_lcs(item.codes.tolist(), words)


@pytest.fixture(scope="module")
def leaky():
    rng = random.Random(11)
    syllables = [a + b for a in "bdfgklmnprstvz" for b in ("a", "e", "i", "o", "u", "ar", "en", "il", "on", "us")]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(vocabulary[: rng.choice((30, 300, 3000))]) for _ in range(n))
    items = [(i, prose(rng.randint(12, 60)) + ". " + prose(4) + ".") for i in range(30)]
    rows, verbatim, reworded = [], set(), set()
    for i in range(300):
        words = prose(rng.randint(20, 400)).split()
        if i % 5 == 0:
            item, text = items[i % 30]
            part = text.split()
            if i % 10 == 0:
                # Reworded: one word in nine left out, and one put in.
                part = [w for k, w in enumerate(part) if k % 9 != 4 or k >= len(part) - 4]
                part.insert(len(part) // 2, "meanwhile")
            (reworded if i % 10 == 0 else verbatim).add((i, item))
            at = rng.randrange(len(words))
            words[at:at] = part
        rows.append(tables.row(i, " ".join(words)))
    return rows, items, verbatim, reworded


def test_all_leaks_are_found_and_no_other(spark, leaky):
    rows, items, verbatim, reworded = leaky
    docs, benchmark = tables.documents(spark, rows), spark.createDataFrame(items, tables.BENCHMARK)
    got = {(r.doc_id, r.item_id) for r in d.contaminated(docs, benchmark).collect()}
    assert verbatim <= got
    assert len(reworded - got) <= 0.1 * len(reworded)
    assert not got - verbatim - reworded
    clean = {r.doc_id for r in d.clean_documents(docs, benchmark).collect()}
    assert clean == {r[0] for r in rows} - {i for i, _ in got}


def test_blocks_of_items_find_the_same(spark, leaky):
    rows, items, *_ = leaky
    docs, benchmark = tables.documents(spark, rows[:60]), spark.createDataFrame(items, tables.BENCHMARK)
    space = d.fit_space(docs, benchmark)

    def found(size):
        return {
            (r[0], ids[leak[0]])
            for index, ids in d.indexes(space, benchmark, size=size) for r in rows[:60] for leak in index.leaks(r[1])
        }

    assert found(7) == found(4096) != set()


def test_distributed_products_equal_the_dense_matrix(spark):
    rng = np.random.default_rng(1)
    words = [rng.integers(0, d.BUCKETS, rng.integers(1, 33)).astype(np.int32) for _ in range(40)]
    rows = spark.createDataFrame([("corpus" if i % 2 else "benchmark", bytearray(w.tobytes())) for i, w in enumerate(words)], "kind string, words binary")
    idf, basis, weights = rng.random(d.BUCKETS) + 0.5, rng.standard_normal((d.BUCKETS, 5)), {"corpus": 1.0, "benchmark": 2.0}
    a = np.zeros((40, d.BUCKETS))
    for i, w in enumerate(words):
        np.add.at(a[i], w, idf[w] * weights["corpus" if i % 2 else "benchmark"] / np.sqrt((idf[w] ** 2).sum()))
    assert np.allclose(d._summed(rows.repartition(3), idf, basis, weights, False), a.T @ (a @ basis), atol=1e-3)
    assert np.allclose(d._summed(rows.repartition(3), idf, basis, weights, True), (a @ basis).T @ (a @ basis), rtol=1e-3, atol=1e-2)


def test_odd_tables(spark):
    docs = tables.clashing(tables.documents(spark, tables.ODD))
    benchmark = spark.createDataFrame([(1, None), (2, ""), (None, "no id here"), (3, "two others"), (3, "two others")], tables.BENCHMARK)
    got = sorted(((r.doc_id, r.item_id) for r in d.contaminated(docs, benchmark).collect()), key=str)
    assert got == [(5, 3), (None, None)]
    assert d.clean_documents(docs, benchmark).columns == docs.columns
    assert d.contaminated(docs, benchmark.limit(0)).isEmpty() and d.clean_documents(docs, benchmark.limit(0)).count() == len(tables.ODD)
    assert d.contaminated(docs.limit(0), benchmark).isEmpty() and d.clean_documents(docs.limit(0), benchmark).isEmpty()


def test_one_block_is_held_at_a_time(spark, leaky, monkeypatch):
    rows, items, *_ = leaky
    docs, benchmark = tables.documents(spark, rows[:60]), spark.createDataFrame(items, tables.BENCHMARK)
    whole = tables.values(d.contaminated(docs, benchmark))
    left = tables.values(d.clean_documents(docs, benchmark))
    alive, write = {}, d.written

    def written(df, name):
        gc.collect()
        alive[name] = sum(isinstance(o, d.Index) for o in gc.get_objects())
        return write(df, name)

    monkeypatch.setattr(d, "written", written)
    monkeypatch.setattr(d.indexes, "__defaults__", ("item_id", "text", len(items) // 2))
    assert tables.values(d.contaminated(docs, benchmark)) == whole and tables.values(d.clean_documents(docs, benchmark)) == left
    for name in ("leaks", "leaking"):
        counts = [n for k, n in alive.items() if k.rstrip("0123456789") == name]
        assert len(counts) > 1 and set(counts) == {1}


def plain_passages(texts):
    """All passages of the texts, each as the buckets of its words."""
    rows = []
    for text in texts:
        at = d.codes_of(text) % d.BUCKETS
        rows += [at[b : b + d.PASSAGE_WORDS] for b in range(0, len(at), d.BLOCK_WORDS)]
    return rows


def test_texts_coded_together_equal_single_ones():
    texts = ["", None, "Ä b", "x" * 70_000 + " y", *(r[1] for r in tables.ODD), *(r[1] for r in tables.some_documents())]
    together = [codes for some in d.codes_together(texts) for codes in some]
    assert [c.tolist() for c in together] == [d.codes_of(t).tolist() for t in texts]


def test_products_of_texts_equal_the_dense_matrix_of_all_passages(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCKS_TOGETHER", 7)
    monkeypatch.setattr(d, "PIECE", 3)
    rows = [*tables.some_documents(30), *tables.ODD]
    kinds = spark.createDataFrame([("benchmark" if i % 3 else "corpus", r[1]) for i, r in enumerate(rows) if r[0] != 7], "kind string, whole string")
    coded = kinds.coalesce(2).mapInPandas(d._coded, "kind string, words binary")
    weights = {"corpus": 1.0, "benchmark": 2.0}
    rng = np.random.default_rng(1)
    idf, basis = rng.random(d.BUCKETS) + 0.5, rng.standard_normal((d.BUCKETS, 5))
    a = []
    for kind, text in kinds.collect():
        for w in plain_passages([text]):
            a.append(np.zeros(d.BUCKETS))
            np.add.at(a[-1], w, idf[w] * weights[kind] / np.sqrt((idf[w] ** 2).sum()))
    a = np.array(a)
    assert np.allclose(d._summed(coded, idf, basis, weights, False, True), a.T @ (a @ basis), rtol=1e-3, atol=1e-3)
    assert np.allclose(d._summed(coded, idf, basis, weights, True, True), (a @ basis).T @ (a @ basis), rtol=1e-3, atol=1e-2)


def test_the_space_is_fitted_on_all_passages(spark):
    rng = random.Random(5)
    words = [a + b for a in tables.WORDS for b in ("", "a", "o", "u")]
    share = [1 / (i + 1) for i in range(len(words))]
    # More passages than the 20,000 that once were drawn.
    texts = [" ".join(rng.choices(words, share, k=rng.randint(500, 620))) for _ in range(650)]
    items = [(i, " ".join(rng.choices(words, k=40))) for i in range(20)]
    docs = tables.documents(spark, [tables.row(i, t) for i, t in enumerate(texts)])
    space = d.fit_space(docs, spark.createDataFrame(items, tables.BENCHMARK))

    used = np.unique(np.concatenate([d.codes_of(w) for w in words]) % d.BUCKETS)
    seen = np.array([[np.isin(used, d.codes_of(t) % d.BUCKETS)] for t in texts]).sum(axis=(0, 1))
    idf = np.log((len(texts) + 1) / (seen + 1)) + 0.1
    parts = []
    for some in (plain_passages(texts), plain_passages(t for _, t in items)):
        a = np.zeros((len(some), len(used)))
        for row, w in zip(a, some):
            np.add.at(row, np.searchsorted(used, w), 1.0)
        # A word that comes twice counts twice in the length.
        parts.append(a * idf / np.sqrt(a @ idf**2)[:, None])
    corpus, benchmark = parts
    assert len(corpus) > 20_000
    both = np.vstack([corpus, benchmark * np.sqrt(len(corpus) / len(benchmark))])
    basis = np.random.default_rng(d.SEED).standard_normal((d.BUCKETS, d.RANK + d.EXTRA), np.float32)[used]
    for _ in range(d.POWER_STEPS):
        basis = np.linalg.qr(both.T @ (both @ basis))[0]
    leading = basis @ np.linalg.eigh((both @ basis).T @ (both @ basis))[1][:, ::-1][:, : d.RANK]
    spread, axes = np.linalg.eigh((corpus @ leading).T @ (corpus @ leading))
    rows = leading @ axes / np.sqrt(np.maximum(spread, 0) + d.FLOOR * spread.mean()) * idf[:, None]
    expected, got = rows @ rows.T, space.rows[used] @ space.rows[used].T
    assert np.abs(got - expected).max() < 0.003 * np.abs(expected).max()
