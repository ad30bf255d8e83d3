"""Medians, rows above a scalar and group means."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallywork.operators import stats

PEOPLE = [
    ("A", 1, 30.0, 7.0),
    ("B", 0, None, 8.0),
    ("C", 0, None, 9.0),
    ("D", 1, 40.0, 30.0),
    ("E", 0, 50.0, None),
]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, "Name string, Survived int, Age double, Fare double")


def numbers(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(4)


def median(df, **options):
    return stats.median_exact(df, "v", **options).first().median


def lower_middle(values, default=None):
    kept = sorted(default if v is None else v for v in values if v is not None or default is not None)
    return kept[(len(kept) + 1) // 2 - 1]


def test_people(spark, people):
    with_default = stats.median_exact(people, "Age")
    assert [tuple(r) for r in with_default.collect()] == [(30.0,)]
    assert stats.median_exact(people, "Age", default=None).first().median == 40.0
    above = stats.above_median(people, "Age", "Name", "Fare", with_default)
    assert [tuple(r) for r in above.collect()] == [("D", 30.0), ("E", None)]
    assert stats.row_count(above).first().cnt == 2
    means = stats.group_mean(people, "Survived", "Fare")
    assert [tuple(r) for r in means.collect()] == [(0, 8.5), (1, 18.5)]
    gap = stats.group_mean_gap(people, "Survived", "Fare", 1, 0).collect()
    assert [tuple(r) for r in gap] == [(18.5, 8.5, 10.0, "noticeably different")]


def test_small_gap_and_missing_group(spark, people):
    near = stats.group_mean_gap(people, "Survived", "Fare", 1, 0, limit=10.5).first()
    assert near.verdict == "not very different"
    missing = stats.group_mean_gap(people, "Survived", "Fare", 1, 2).first()
    assert tuple(missing) == (18.5, None, None, None)


SHAPES = {
    "uniform": lambda r: r.random(),
    "heavy tail": lambda r: math.exp(r.gauss(0, 8)),
    "signed tail": lambda r: r.choice([-1, 1]) * 10 ** r.uniform(-300, 300),
    "few values": lambda r: float(r.randrange(5)),
    "one hot value": lambda r: 3.25 if r.random() < 0.6 else r.gauss(0, 100),
    "largest doubles": lambda r: r.choice([-1, 1]) * r.uniform(1.6e308, 1.79e308),
    "infinite ends": lambda r: r.choice([math.inf, -math.inf, r.gauss(0, 1), r.gauss(0, 1)]),
    "smallest doubles": lambda r: 5e-324 * r.randrange(4),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_narrowing_finds_the_lower_middle_element(spark, shape):
    rng = random.Random(shape)
    values = [SHAPES[shape](rng) for _ in range(1001 + rng.randrange(2))]
    df = numbers(spark, values)
    for options in ({}, {"settle_rows": 10}, {"settle_rows": 0, "sketch_size": 20}):
        assert median(df, **options) == lower_middle(values)


def test_nulls_take_the_default_and_nan_is_left_out(spark):
    values = [None, None, 1.0, 50.0, 60.0]
    assert median(numbers(spark, values)) == lower_middle(values, 23.0) == 23.0
    assert median(numbers(spark, [1.0, math.nan, 2.0, 3.0])) == 2.0


def test_whole_numbers_and_tables_without_values(spark):
    assert median(numbers(spark, [4, 1, 3, 2], "int")) == 2.0
    assert median(numbers(spark, [])) is None
    assert median(numbers(spark, [None, None]), default=None) is None
    assert median(numbers(spark, [7.0])) == 7.0


@pytest.mark.parametrize("error", [0.01, 0.1])
def test_approximate_median_has_a_rank_near_the_middle(spark, error):
    rng = random.Random(3)
    values = [rng.expovariate(1) for _ in range(20_000)]
    found = stats.median_approx(numbers(spark, values), "v", relative_error=error).first().median
    rank = sorted(values).index(found) + 1
    assert abs(rank - len(values) / 2) <= error * len(values)


def test_approximate_median_of_the_events(spark):
    from tallywork.plans import registry

    events = registry.events(spark, "/root/testdata/sf0.01")
    values = sorted(23.0 if r.value is None else r.value for r in events.collect())
    found = registry.median_approx(spark, "/root/testdata/sf0.01").first().median
    below = sum(v < found for v in values)
    up_to = sum(v <= found for v in values)
    assert below - 0.01 * len(values) <= len(values) / 2 <= up_to + 0.01 * len(values)


def test_sketches_are_merged_in_groups(spark, capsys):
    wide = spark.range(0, 10_000, numPartitions=500).select(F.col("id").cast("double").alias("v"))
    sketch = stats._sketched(wide, 200)
    capsys.readouterr()
    sketch.explain()
    text = capsys.readouterr().out
    assert text.index("SinglePartition") < text.index("hashpartitioning(sketch_group")
    found = sketch.select(F.kll_sketch_get_n_double("sketch").alias("n")).first()
    assert found.n == 10_000


def test_null_is_never_above(spark):
    df = numbers(spark, [None, 1.0, 2.0, 3.0])
    scalar = spark.createDataFrame([(2.0,)], "x double")
    assert [r.v for r in stats.above_scalar(df, "v", scalar).collect()] == [3.0]
    nothing = spark.createDataFrame([(None,)], "x double")
    assert stats.above_scalar(df, "v", nothing).count() == 0
