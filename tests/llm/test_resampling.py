import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywork.llm import resampling
from tests.llm import tables
from tests.llm.test_boosting import junk


def corpus():
    rng = random.Random(5)
    good = [tables.row(i, tables.prose(rng, rng.randint(3, 150))) for i in range(150)]
    bad = [tables.row(1000 + i, junk(rng, rng.randint(30, 150))) for i in range(15)]
    loud = [tables.row(2000 + i, tables.prose(rng, 80).upper()) for i in range(15)]
    again = [tables.row(3000 + i, " ".join(w for w in tables.prose(rng, 30).split() for _ in range(4))) for i in range(15)]
    return good, bad + loud + again


def labelled(spark, rows):
    return spark.createDataFrame([(r[0], int(r[0] < 1000), 0) for r in rows if r[0] % 2] + [(None, 1, 0), (2, None, 0)], tables.LABELS)


def test_counts_cover_all_rows_and_equal_a_plain_model(spark):
    good, bad = corpus()
    rows = good + bad
    ratio = resampling.fit(tables.documents(spark, rows), labelled(spark, rows))
    size = resampling.WORD_BUCKETS + resampling.SHAPE_BUCKETS
    raw, target = np.zeros(size), np.zeros(size)
    for doc_id, text, *_ in rows:
        seen = np.bincount(resampling.buckets_of(text), minlength=size)
        raw += seen
        target += seen * (doc_id < 1000 and doc_id % 2)
    for part in (slice(0, resampling.WORD_BUCKETS), slice(resampling.WORD_BUCKETS, None)):
        p, q = target[part] + 1, raw[part] + 1
        assert np.allclose(ratio[part], np.log(p / p.sum()) - np.log(q / q.sum()))


def test_clean_documents_stay_and_junk_goes(spark):
    good, bad = corpus()
    labels = labelled(spark, good + bad)
    docs = tables.clashing(tables.documents(spark, good + bad))
    kept = resampling.sampled_documents(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids >= {r[0] for r in good} and len(ids & {r[0] for r in bad}) <= 2
    assert ids == {r.doc_id for r in resampling.resample(docs, labels).where("kept").collect()}


@pytest.mark.parametrize("k", [0, 1, 7, 500, 999, 1000, 2000])
def test_kth_largest_equals_sorting(spark, k):
    rng = random.Random(k)
    values = [rng.choice([rng.gauss(0, 1), rng.expovariate(0.001), 3.25, -1e6]) for _ in range(1000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    limit = resampling.kth_largest(rows, "v", k)
    reached = sum(v >= limit for v in values)
    order = sorted(values, reverse=True)
    assert reached == (sum(v >= order[k - 1] for v in values) if 0 < k <= 1000 else min(k, 1000))


def test_noise_is_gumbel_and_the_same_in_every_run(spark):
    rows = spark.range(20_000).withColumn("x", F.lit(1))
    noise = [r.g for r in rows.select(resampling.gumbel(5, "id", "x").alias("g")).collect()]
    assert noise == [r.g for r in rows.select(resampling.gumbel(5, "id", "x").alias("g")).collect()]
    assert abs(np.mean(noise) - 0.5772) < 0.05 and abs(np.var(noise) - math.pi**2 / 6) < 0.1


def inclusion(weights, k):
    """The chance of each row to be among k draws without replacement, draw by draw."""
    chance = dict.fromkeys(range(len(weights)), 0.0)

    def draw(left, p, k):
        if not k:
            return
        total = sum(weights[i] for i in left)
        for i in left:
            chance[i] += p * weights[i] / total
            draw(left - {i}, p * weights[i] / total, k - 1)

    draw(frozenset(chance), 1.0, k)
    return [chance[i] for i in range(len(weights))]


def test_samples_are_drawn_in_proportion_to_weights_without_replacement(spark):
    weights, k, seeds = [8.0, 4.0, 2.0, 1.0, 1.0, 0.5, 0.1], 3, 20_000
    rows = spark.createDataFrame([(i, math.log(w)) for i, w in enumerate(weights)], "key_id long, log_weight double")
    draws = rows.join(spark.range(seeds).withColumnRenamed("id", "seed"), F.col("seed").isNotNull())
    keys = draws.select("seed", "key_id", (F.col("log_weight") + resampling.gumbel(F.col("seed"), "key_id")).alias("key")).toPandas()
    taken = keys.sort_values("key", ascending=False).groupby("seed").head(k)["key_id"].value_counts()
    for i, chance in enumerate(inclusion(weights, k)):
        error = 5 * math.sqrt(chance * (1 - chance) / seeds)
        assert abs(taken.get(i, 0) / seeds - chance) < error


def test_stated_sizes_shares_and_seeds(spark):
    good, bad = corpus()
    labels = labelled(spark, good + bad)
    docs = tables.documents(spark, good + bad)
    found = resampling.resample(docs, labels, size=40, seed=8).collect()
    order = sorted(found, key=lambda r: -r.gumbel_key)
    assert {r.doc_id for r in found if r.kept} == {r.doc_id for r in order[:40]}
    same = resampling.sampled_documents(docs, labels, share=40 / len(found), seed=8)
    assert {r.doc_id for r in same.collect()} == {r.doc_id for r in order[:40]}
    other = resampling.resample(docs, labels, size=40, seed=9).where("kept").collect()
    assert len(other) == 40 and {r.doc_id for r in other} != {r.doc_id for r in order[:40]}


def test_long_tokens_are_not_remembered():
    resampling.buckets_of("w" * 100_000 + " " + "#" * 100_000 + " " + " ".join(map(str, range(resampling.MEMORY + 10))))
    assert len(resampling._codes) <= resampling.MEMORY
    assert max(map(len, resampling._codes)) <= resampling.MEMORY_CHARS


def test_odd_tables(spark):
    docs = tables.clashing(tables.documents(spark, tables.ODD))
    none = spark.createDataFrame([], tables.LABELS)
    got = resampling.resample(docs, none).collect()
    assert len(got) == len(tables.ODD) and all(r.kept and r.log_weight == 0 for r in got)
    assert resampling.resample(docs.limit(0), none).isEmpty()
    assert resampling.sampled_documents(docs, none).count() == len(tables.ODD)
