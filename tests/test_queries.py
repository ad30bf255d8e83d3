"""Every registered query next to its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as entry
from tallywork.plans import registry
from tallywork.plans.oracle import ORACLE
from tallywork.sources import read_lines
from tests.compare import database, duck_rows, spark_rows, types_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    connection = database(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF_DIR)
    sql = ORACLE[name]
    ours, theirs = types_of(df, con, sql)
    assert ours == theirs
    assert spark_rows(df) == duck_rows(con, sql)


def test_only_the_approximate_median_has_no_sql():
    assert set(registry.QUERIES) - set(ORACLE) == {"median_approx"}
    assert set(registry.QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_recursion_is_what_finds_nested_files(spark):
    path = registry.nested_corpus(spark, SF_DIR)
    assert read_lines(spark, path).count() == 0
    assert read_lines(spark, path, recursive=True).count() > 0


def test_flagship_query(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 100
    assert rows == sorted(rows, key=lambda r: (-r.cnt, r.token))


def test_last_step_of_the_series_is_the_whole_corpus(spark):
    series = entry.queries()["prefix_token_counts"](spark, SF_DIR)
    last = series.where("step = 19").drop("step")
    whole = entry.queries()["token_counts"](spark, SF_DIR)
    assert last.exceptAll(whole).isEmpty() and whole.exceptAll(last).isEmpty()
