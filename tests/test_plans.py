"""The physical plans keep the properties that matter at scale."""

import re
from types import SimpleNamespace

import pytest

from tallywork.plans import registry
from tallywork.session import TEXT_PARTITIONS, scratch_path, settings_for, shuffle_partitions_for

SF_DIR = "/root/testdata/sf0.001"
MIB = 1024 * 1024


def plan(spark, name, capsys):
    df = registry.QUERIES[name](spark, SF_DIR)
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_workers_and_no_product_joins(spark, name, capsys):
    text = plan(spark, name, capsys)
    for bad in ("Python", "CartesianProduct", "NestedLoopJoin", "ExistingRDD"):
        assert bad not in text


@pytest.mark.parametrize("name", ["token_counts", "pair_counts", "prefix_pair_counts"])
def test_counts_are_added_up_before_the_shuffle(spark, name, capsys):
    assert "partial_count" in plan(spark, name, capsys)


def test_only_the_text_is_read(spark, capsys):
    assert "ReadSchema: struct<text:string>" in plan(spark, "pair_counts", capsys)


def test_key_filters_run_before_the_shuffle(spark, capsys):
    for name in ("words_with_count", "top_number_word_pairs", "prefix_top_words"):
        text = plan(spark, name, capsys)
        assert text.index("partial_count") < text.index("RLIKE")


def test_top_lists_keep_k_rows_per_task(spark, capsys):
    assert "TakeOrderedAndProject" in plan(spark, "top_words", capsys)
    text = plan(spark, "prefix_top_words", capsys)
    # Spans are cut to k per first step, on both sides of the shuffle, before
    # single steps are spelled out.
    steps = text.index("Generate explode(sequence")
    shuffle = text.index("Exchange hashpartitioning(first_step")
    assert steps < text.index("Final", steps) < shuffle < text.index("Partial", shuffle)


def test_series_looks_at_spans_before_steps(spark, capsys):
    text = plan(spark, "prefix_words_with_count", capsys)
    assert text.index("Generate explode(sequence") < text.index("= 3)")


def test_group_filter_reaches_the_scan(spark, capsys):
    text = plan(spark, "group_mean_gap", capsys)
    assert "PushedFilters: [In(o_orderstatus, [F,O])]" in text
    assert "struct<o_orderstatus:string,o_totalprice:double>" in text


def test_scalars_are_subqueries(spark, capsys):
    assert "Subquery" in plan(spark, "above_median_count", capsys)


def test_shuffle_partitions_grow_with_the_input():
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(100 * 1024 * MIB, 8) == 400
    assert shuffle_partitions_for(100 * 1024**2 * MIB, 8) == 409_600
    assert settings_for(1024**2 * MIB, 8, split_mib=512)["spark.sql.files.maxPartitionBytes"] == str(512 * MIB)
    assert settings_for(1024 * MIB, 1, expansion=4)["spark.sql.shuffle.partitions"] == "16"


def test_plans_have_one_shape_at_every_size(spark, capsys):
    shapes = set()
    for cores in ("4", "8"):
        for sf in ("sf0.001", "sf0.1"):
            spark.conf.set(TEXT_PARTITIONS, cores)
            capsys.readouterr()
            registry.pair_counts(spark, f"/root/testdata/{sf}").explain()
            lines = capsys.readouterr().out.splitlines()
            shapes.add(tuple(re.sub(r"[^A-Za-z].*", "", line.lstrip(" +-:*()0123456789")) for line in lines))
    spark.conf.set(TEXT_PARTITIONS, "8")
    assert len(shapes) == 1


def test_queries_leave_the_session_as_it_is(spark):
    before = spark.conf.getAll
    registry.pair_counts(spark, SF_DIR)
    assert spark.conf.getAll == before


class Settings(dict):
    """Stands in for a session with the given master and settings."""

    def __init__(self, master, **settings):
        super().__init__(settings)
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = self


def test_scratch_folder_follows_the_session(spark):
    shared = Settings("yarn", **{"spark.checkpoint.dir": "hdfs://nn/shared/"})
    first, second = scratch_path(shared, "x"), scratch_path(shared, "x")
    assert first.startswith("hdfs://nn/shared/x-") and first != second
    unset = Settings("yarn", **{"spark.sql.warehouse.dir": "hdfs://nn/warehouse"})
    assert scratch_path(unset, "x").startswith("hdfs://nn/warehouse/scratch/x-")


def test_spans_are_sorted_by_a_hash_first(spark, capsys):
    assert re.search(r"Sort \[_w\d+#\d+L ASC", plan(spark, "prefix_pair_counts", capsys))
