import hashlib

import pytest
from pyspark.sql import functions as F

from tallywork.llm import merkle, queries
from tallywork.llm.oracle import ORACLE
from tests.compare import database, duck_rows, spark_rows
from tests.llm import tables

SCHEMA = "file string, offset bigint, digest string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def records(n=400, files=5):
    return [(f"f{i % files}", (i // files) * 20_000, digest(str(i))) for i in range(n)]


def tree(spark, rows):
    return merkle.hash_tree(spark.createDataFrame(rows, SCHEMA))


def test_equal_replicas_have_equal_trees_in_any_order(spark):
    rows = records()
    assert tables.values(tree(spark, rows)) == tables.values(tree(spark, rows[::-1]))
    assert merkle.audit(tree(spark, rows), tree(spark, rows[::-1])).isEmpty()


def test_every_kind_of_damage_is_located(spark):
    rows = records()
    worn = [r for i, r in enumerate(rows) if i != 17]
    worn[100] = (*worn[100][:2], digest("flipped"))
    worn.append(("f9", 0, digest("new")))
    got = {(r.file, r.offset): r.status for r in merkle.audit(tree(spark, rows), tree(spark, worn)).collect()}
    assert got == {rows[17][:2]: "missing", rows[101][:2]: "changed", ("f9", 0): "extra"}


def test_nodes_of_a_small_file_by_hand(spark):
    rows = [("f", 0, "a"), ("f", 70_000, "b")]
    got = {(r.level, r.place): r.digest for r in tree(spark, rows).collect()}
    low, high = digest("0:a"), digest("70000:b")
    assert got[1, 0] == low and got[1, 1] == high
    assert got[2, 0] == digest(f"0:{low},1:{high}")
    assert (merkle.ROOT, 0) in got


def test_odd_records(spark):
    rows = [(None, None, None), (None, 3, "x"), ("f", 0, "a"), ("f", 0, "a"), ("f", 1, "b"), ("f", 1, "c"), ("f", 1, "d")]
    assert merkle.audit(tree(spark, rows), tree(spark, rows[::-1])).isEmpty()
    fewer = rows[:2] + rows[3:]
    assert [tuple(r)[:3] for r in merkle.audit(tree(spark, rows), tree(spark, fewer)).collect()] == [("f", 0, "changed")]
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.audit(merkle.hash_tree(empty), merkle.hash_tree(empty)).isEmpty()
    assert merkle.audit(tree(spark, rows), merkle.hash_tree(empty)).count() == 4


def test_records_of_null_parts(spark):
    one = spark.range(1).select(merkle.warc_record(F.lit(None), F.lit(None), F.lit(None)).alias("d")).first()
    assert bytes(one.d).endswith(b"Content-Length: 0\r\n\r\n\r\n\r\n")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    con = database(sf_dir)
    assert spark_rows(queries.QUERIES[name](spark, sf_dir)) == duck_rows(con, ORACLE[name])
    con.close()
