"""Run the registered queries next to their SQL and compare whole results."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def spark_rows(df):
    order = sorted(df.columns)
    return order, Counter(map(tuple, df.select(*order).collect()))


def duck_rows(con, sql):
    result = con.sql(sql)
    order = sorted(result.columns)
    columns = ", ".join(f'"{name}"' for name in order)
    return order, Counter(con.sql(f"SELECT {columns} FROM ({sql})").fetchall())


def types_of(df, con, sql):
    duck = {n: str(t).lower() for n, t in zip(con.sql(sql).columns, con.sql(sql).types)}
    names = {"int": "integer", "string": "varchar"}
    return {n: names.get(t, t) for n, t in df.dtypes}, duck


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tallywork.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(8), database(sf_dir)
    for name in wanted:
        begin = time.time()
        df = entry.queries()[name](spark, sf_dir)
        columns, ours = spark_rows(df)
        middle = time.time()
        sql = entry.oracle_sql().get(name)
        if sql is None:
            print(f"{name}: no SQL, {sum(ours.values())} rows, {middle - begin:.1f}s", flush=True)
            continue
        other, theirs = duck_rows(con, sql)
        a, b = types_of(df, con, sql)
        good = columns == other and ours == theirs and a == b
        print(
            f"{name}: {'same' if good else 'DIFFERENT'} {sum(ours.values())} rows "
            f"{middle - begin:.1f}s / {time.time() - middle:.1f}s",
            flush=True,
        )
        if not good:
            print(columns, other, a, b, list((ours - theirs).items())[:3], list((theirs - ours).items())[:3])
