"""Selections, top lists and the growing series."""

import random

import pytest
from pyspark.sql import functions as F

from tallywork.operators import prefix, select
from tallywork.operators.counts import count_tokens


def counts(spark, data):
    return spark.createDataFrame(data, "token string, cnt bigint").repartition(4)


def test_ties_at_the_cut_go_by_key(spark):
    table = counts(spark, [("delta-x", 7), ("gamma-x", 5), ("beta-xx", 5), ("alpha-x", 5)])
    assert [tuple(r) for r in select.top_words(table, 2).collect()] == [("delta-x", 7), ("alpha-x", 5)]


def test_top_list_holds_words_only_and_may_be_short(spark):
    table = counts(spark, [("1234", 9), ("history", 5), ("short", 8)])
    assert [r.token for r in select.top_words(table).collect()] == ["history"]


def test_count_equals_is_row_wise(spark):
    # A key that comes from two inputs stays two rows and is not added up.
    table = counts(spark, [("history", 500), ("history", 500), ("museum", 1000), ("1234", 1000)])
    assert [r.token for r in select.words_with_count(table).collect()] == ["museum"]
    assert select.words_with_count(table, 500).count() == 2


def test_number_word_pairs_check_order_and_length(spark):
    table = spark.createDataFrame(
        [("1234", "history", 1), ("history", "1234", 1), ("999", "history", 1), ("1234", "5678", 1)],
        "left string, right string, cnt bigint",
    )
    assert [tuple(r) for r in select.top_number_word_pairs(table).collect()] == [("1234", "history", 1)]


@pytest.fixture
def occurrences(spark):
    rng = random.Random(7)
    words = [f"word-{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    # A third of all rows is one word, and another third is one source.
    data = [("word-hot", rng.randrange(6)) for _ in range(2000)]
    data += [(rng.choice(words), 2) for _ in range(2000)]
    data += [(rng.choice(words), rng.randrange(6)) for _ in range(2000)]
    return spark.createDataFrame(data, "token string, step int").repartition(5)


def direct(occurrences, step):
    return {r.token: r.cnt for r in count_tokens(occurrences.where(F.col("step") <= step)).collect()}


def test_every_step_equals_a_direct_count(spark, occurrences):
    spans = prefix.token_spans(occurrences, 6)
    got = {}
    for r in prefix.by_step(spans).collect():
        got.setdefault(r.step, {})[r.token] = r.cnt
    # Step 6 is a source without rows and repeats step 5.
    assert got == {step: direct(occurrences, step) for step in range(7)}


def test_series_selections_equal_direct_ones(spark, occurrences):
    spans = prefix.token_spans(occurrences, F.lit(5))
    equal = prefix.prefix_words_with_count(spans, 4).collect()
    assert sorted((r.step, r.token) for r in equal) == sorted(
        (step, t) for step in range(6) for t, c in direct(occurrences, step).items() if c == 4
    )


@pytest.mark.parametrize("threshold", ["1000", "3"])
def test_series_top_lists(spark, occurrences, threshold):
    # With the low threshold k lies beyond it, so the two-stage ranking runs.
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        top = prefix.prefix_top_words(prefix.token_spans(occurrences, 6), 20).collect()
    finally:
        spark.conf.set(key, before)
    for step in range(7):
        ranked = sorted(direct(occurrences, step).items(), key=lambda x: (-x[1], x[0]))[:20]
        assert sorted((r.token, r.cnt) for r in top if r.step == step) == sorted(ranked)


def test_results_do_not_depend_on_the_partitioning(spark, occurrences):
    one = prefix.by_step(prefix.token_spans(occurrences.coalesce(1), 5))
    many = prefix.by_step(prefix.token_spans(occurrences.repartition(13, "token"), 5))
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
