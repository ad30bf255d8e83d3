"""Sources and sinks on files in a fresh folder."""

import gzip
import random
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallywork import session
from tallywork.plans import jobs
from tallywork.sinks import counts as sinks_counts
from tallywork.sinks import layout_path, write_counts, write_spans_by_range, write_top
from tallywork.sources import (
    dealt,
    read_csv_table,
    read_lines,
    read_pair_counts,
    read_sources,
    read_token_counts,
)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def part_lines(path):
    return [p.read_text().splitlines() for p in sorted(path.glob("part-*")) if p.stat().st_size]


@pytest.fixture
def corpus(tmp_path):
    base = tmp_path / "corpus" / "wiki"
    put(base / "AA" / "one.txt", "history museum\r\nhistory 1234\rmuseum\n")
    put(base / "AA" / "deep" / "two.txt", "archive history\n")
    put(base / "AB" / "one.txt", "history 1234 archive\n")
    put(base / "AC" / "AA" / "one.txt", "1234 archive history\n")
    put(base / "AC" / "_skipped.txt", "hidden hidden\n")
    return base


def test_lines_end_at_lf_cr_and_crlf(spark, corpus):
    lines = read_lines(spark, f"{corpus}/AA, {corpus}/AB")
    assert rows(lines) == [
        ("history 1234",), ("history 1234 archive",), ("history museum",), ("museum",),
    ]


def test_nested_files_need_the_recursive_option(spark, corpus):
    assert read_lines(spark, str(corpus)).count() == 0
    assert read_lines(spark, [str(corpus)], recursive=True).count() == 6


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_source_is_the_directory_below_the_base(spark, corpus, scheme):
    lines = read_sources(spark, f"{scheme}{corpus}/", ["AA", "AC"])
    assert rows(lines.groupBy("source").count()) == [("AA", 4), ("AC", 1)]


@pytest.mark.parametrize("name", ["A A", "b+c", "d%20e", "é", "x=y", "AA"])
def test_source_names_with_special_characters(spark, tmp_path, name):
    put(tmp_path / "my corpus+" / name / "deep" / "f.txt", "history\n")
    lines = read_sources(spark, str(tmp_path / "my corpus+"), [name])
    assert rows(lines) == [("history", name)]


def test_base_is_stripped_at_the_start_of_the_path_only(spark, corpus, monkeypatch):
    doubled = str(corpus).replace("/corpus/", "//corpus/./")
    assert rows(read_sources(spark, doubled, ["AB"])) == [("history 1234 archive", "AB")]
    # A base whose name occurs again below it and above it.
    put(corpus / "wiki" / "wiki" / "f.txt", "history\n")
    assert rows(read_sources(spark, str(corpus), ["wiki"])) == [("history", "wiki")]
    inner = corpus / "raw" / "wiki" / "AA" / "f.txt"
    put(inner, "museum\n")
    assert rows(read_sources(spark, str(inner.parents[1]), ["AA"])) == [("museum", "AA")]


def label(spark, file, base):
    from tallywork.sources.text import _source_of

    return spark.range(1).select(_source_of(spark, F.lit(file), base)).first()[0]


def test_host_or_bucket_named_like_the_folder(spark):
    base = "viewfs://wiki/wiki"
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.wiki.link./wiki", "file:///tmp")
    assert label(spark, "viewfs://wiki/wiki/AA/f.txt", base) == "AA"
    for file in ("viewfs://wiki/raw/wiki/AA/f.txt", "viewfs://other/wiki/AA/f.txt", "/wiki/AA/f.txt"):
        with pytest.raises(Exception, match="not below"):
            label(spark, file, base)


def test_relative_base_is_taken_from_the_working_directory(spark):
    here = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("wiki")
    system = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = system.makeQualified(here).toString()
    assert label(spark, f"{full}/AA/raw/wiki/AB/f.txt", "wiki") == "AA"


def test_counts_up_to_64_bits(spark, tmp_path):
    kept = {"a": 2**63 - 1, "b": -(2**63), "c": 42, "d": -7}
    texts = {"a": str(2**63 - 1), "b": str(-(2**63)), "c": "0" * 40 + "42", "d": "-" + "0" * 20 + "7", "e": str(2**63), "f": "9" * 30}
    put(tmp_path / "t" / "c.txt", "".join(f"{k}\t{v}\n" for k, v in texts.items()))
    put(tmp_path / "u" / "c.txt", "".join(f"({k},{v})\n" for k, v in texts.items()))
    assert dict(rows(read_token_counts(spark, str(tmp_path / "t")))) == kept
    assert dict(rows(read_token_counts(spark, str(tmp_path / "u"), "tuple"))) == kept


def test_counts_in_tsv_form(spark, tmp_path):
    put(
        tmp_path / "c.txt",
        "History\t1000\nhistory\tx\nhistory\nhistory 5 6\nmuseum 7  \n leading\t3\n\n",
    )
    assert rows(read_token_counts(spark, str(tmp_path))) == [("history", 1000), ("museum", 7)]


def test_counts_in_tuple_form(spark, tmp_path):
    put(tmp_path / "c.txt", "(1,234,5)\n(history,x)\nhistory,5\n(history, 6 )\n(a)\n")
    counts = read_token_counts(spark, str(tmp_path), "tuple")
    assert rows(counts) == [("1,234", 5), ("history", 6)]


def test_pair_counts_need_two_parts(spark, tmp_path):
    put(tmp_path / "t" / "c.txt", "a:b\t5\nab\t5\na:b:c\t5\na:\t5\n1,234:b\t6\n")
    assert rows(read_pair_counts(spark, str(tmp_path / "t"))) == [("1,234", "b", 6), ("a", "b", 5)]
    put(tmp_path / "u" / "c.txt", "(a:b,5)\n(ab,5)\n(1,234:b,6)\n")
    pairs = read_pair_counts(spark, str(tmp_path / "u"), "tuple")
    assert rows(pairs) == [("1,234", "b", 6), ("a", "b", 5)]


#: What a line must look like: key, or left and right, and count.
LINES = {
    ("tsv", read_token_counts): r"(\S+)\s+([+-]?[0-9]+)\s*",
    ("tsv", read_pair_counts): r"([^\s:]+):([^\s:]+)\s+([+-]?[0-9]+)\s*",
    ("tuple", read_token_counts): r"\(([^\n\r\x85\u2028\u2029]*),\s*([+-]?[0-9]+)\s*\)",
    ("tuple", read_pair_counts): r"\(\s*([^:]*):([^:]*[^\s:])\s*,\s*([+-]?[0-9]+)\s*\)",
}


@pytest.mark.parametrize("form,read", LINES)
def test_random_lines_are_read_as_their_form_says(spark, tmp_path, form, read):
    rng = random.Random(17)
    parts = ["a", "Bc", "1,2", ":", ":", ",", ",", "(", ")", "\t", " ", " ", "7", "-12", "+3", "0x", "\x0b", "\u2028", "é", "\xa0"]
    wrap = {"tsv": "%s\t%s", "tuple": "(%s,%s)"}[form]
    lines = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    lines += [wrap % ("".join(rng.choice(parts) for _ in range(rng.randint(0, 5))), rng.choice(parts)) for _ in range(16000)]
    (tmp_path / "c.txt").write_text("\n".join(lines), encoding="utf-8", newline="\n")
    told = [re.fullmatch(LINES[form, read], x.lower() if form == "tsv" else x, re.A) for x in lines]
    expected = sorted((*m.groups()[:-1], int(m.groups()[-1])) for m in told if m)
    assert len(expected) > 100
    assert rows(read(spark, str(tmp_path), form)) == expected


def test_unknown_form_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        read_token_counts(spark, str(tmp_path), "json")


@pytest.mark.parametrize("form", ["tsv", "tuple"])
def test_counts_survive_a_round_trip(spark, tmp_path, form):
    tokens = spark.createDataFrame([("1,234", 5), ("history", 2**40)], "token string, cnt bigint")
    write_counts(tokens, str(tmp_path / "t"), form)
    assert rows(read_token_counts(spark, str(tmp_path / "t"), form)) == rows(tokens)
    pairs = spark.createDataFrame(
        [("1,234", "history", 5), ("-1999", "______", 1)], "left string, right string, cnt bigint"
    )
    write_counts(pairs, str(tmp_path / "p"), form)
    assert rows(read_pair_counts(spark, str(tmp_path / "p"), form)) == rows(pairs)


def test_written_forms(spark, tmp_path):
    pairs = spark.createDataFrame(
        [("bb", "x", 1), ("b", "x", 2), ("b-", "x", 3)], "left string, right string, cnt bigint"
    ).coalesce(1)
    write_counts(pairs, str(tmp_path / "tsv"))
    assert part_lines(tmp_path / "tsv") == [["b-:x\t3", "b:x\t2", "bb:x\t1"]]
    write_counts(pairs, str(tmp_path / "tuple"), "tuple")
    assert sorted(part_lines(tmp_path / "tuple")[0]) == ["(b-:x,3)", "(b:x,2)", "(bb:x,1)"]


def test_an_existing_output_is_refused(spark, tmp_path):
    counts = spark.createDataFrame([("history", 1)], "token string, cnt bigint")
    path = layout_path(str(tmp_path), "token_counts", ["AA", "AB"])
    assert path.endswith("/job=token_counts/range=AA-AB")
    write_counts(counts, path)
    with pytest.raises(AnalysisException):
        write_counts(counts, path)
    with pytest.raises(AnalysisException):
        write_top(counts, path)
    assert rows(spark.read.text(str(tmp_path))) == [("history\t1", "token_counts", "AA-AB")]


def test_top_list_is_one_file_in_rank_order(spark, tmp_path):
    top = spark.createDataFrame(
        [("betass", 5), ("alphas", 5), ("deltas", 70), ("gammas", 6)], "token string, cnt bigint"
    ).repartition(3)
    write_top(top, str(tmp_path / "t"), "tuple")
    assert part_lines(tmp_path / "t") == [["(deltas,70)", "(gammas,6)", "(alphas,5)", "(betass,5)"]]


def test_csv_types_are_inferred_or_given(spark, tmp_path):
    put(tmp_path / "p.csv", 'Name,Survived,Age,Fare\n"Doe, A",1,30.5,7\nB,0,,8.5\n')
    table = read_csv_table(spark, str(tmp_path / "p.csv"))
    assert table.dtypes == [
        ("Name", "string"), ("Survived", "int"), ("Age", "double"), ("Fare", "double"),
    ]
    assert rows(table.select("Name", "Age"))[0] == ("B", None)
    given = read_csv_table(
        spark, str(tmp_path / "p.csv"), "Name string, Survived bigint, Age float, Fare string"
    )
    assert dict(given.dtypes)["Fare"] == "string" and given.count() == 2


def test_texts_are_dealt_out_only_on_demand(spark):
    rows = spark.range(0, 100, numPartitions=3)
    assert dealt(rows, None) is rows
    assert dealt(rows, 5).select(F.spark_partition_id()).distinct().count() == 5


def test_a_top_list_is_cut_to_k(spark, tmp_path):
    top = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "token string, cnt bigint")
    write_top(top, str(tmp_path / "t"), k=2)
    assert part_lines(tmp_path / "t") == [["b\t3", "c\t2"]]


@pytest.mark.parametrize("form", ["tsv", "tuple"])
def test_series_equals_the_single_jobs(spark, corpus, tmp_path, form):
    single, series = str(tmp_path / "single"), str(tmp_path / "series")
    sources = ["AA", "AB", "AC"]
    for last in range(1, 4):
        chosen = sources[:last]
        for job in jobs.COUNT_JOBS:
            jobs.run_count_job(spark, job, str(corpus), chosen, single, form)
        for name, job in jobs.SELECT_JOBS.items():
            limit = 3 if job.is_top else 2
            jobs.run_select_job(spark, name, chosen, single, form, limit)
    jobs.run_series(spark, str(corpus), sources, series, form, n=2, k=3)
    expected = rows(spark.read.text(single).select("job", "range", "value"))
    assert rows(spark.read.text(series).select("job", "range", "value")) == expected
    assert {r[:2] for r in expected} >= {("token_counts", "AA-AA"), ("pair_counts", "AA-AC")}
    top = tmp_path / "series" / "job=top_words" / "range=AA-AC"
    ranked = ["(history,5)", "(archive,3)", "(museum,2)"]
    assert part_lines(top) == [ranked if form == "tuple" else [r[1:-1].replace(",", "\t") for r in ranked]]


def test_a_long_top_list_is_never_cut_without_k(spark, tmp_path):
    top = spark.range(1, 102).selectExpr("cast(id AS string) AS token", "id AS cnt")
    with pytest.raises(ValueError):
        write_top(top, str(tmp_path / "t"))
    write_top(top, str(tmp_path / "t"), k=101)
    assert len(part_lines(tmp_path / "t")[0]) == 101


def shuffled_rows(spark, tmp_path, monkeypatch, sources):
    """The rows that ``run_series`` hands to a partitioned writer, by output."""
    handed, write = {}, jobs.write_by_range

    def counted(steps, path, *args, **kwargs):
        handed[path.rsplit("=", 1)[1]] = steps.count()
        write(steps, path, *args, **kwargs)

    monkeypatch.setattr(jobs, "write_by_range", counted)
    for i, name in enumerate(sources):
        put(tmp_path / "c" / name / "f.txt", f"history museum {1000 + i}\n")
    jobs.run_series(spark, str(tmp_path / "c"), sources, str(tmp_path / "out"), n=1, k=2, compression="gzip")
    return handed


def test_counts_of_a_series_are_written_compressed_and_not_by_a_shuffle(spark, tmp_path, monkeypatch):
    sources = ["A#A", "A%B", "A C", "é"]
    assert set(shuffled_rows(spark, tmp_path, monkeypatch, sources)) == set(jobs.SELECT_JOBS)
    out = tmp_path / "out"
    for job in jobs.COUNT_JOBS:
        names = sorted(p.name for p in (out / f"job={job}").glob("range=*"))
        # The folders that Spark's partitioned writer makes.
        assert names == sorted(["range=A%23A-A%23A", "range=A%23A-A%25B", "range=A%23A-A C", "range=A%23A-é"])
        parts = [p for p in (out / f"job={job}").glob("range=*/part-*")]
        assert parts and all(p.suffix == ".gz" for p in parts)
    read = spark.read.text(str(out / "job=token_counts"))
    assert rows(read.where(F.col("range") == "A#A-A%B").select("value")) == [("1000\t1",), ("1001\t1",), ("history\t2",), ("museum\t2",)]
    # Top lists stay plain.
    assert [p for p in (out / "job=top_words").glob("range=*/part-*") if p.suffix == ".gz"] == []
    with pytest.raises(AnalysisException):
        jobs.run_series(spark, str(tmp_path / "c"), sources, str(out))


def spans_table(spark, tmp_path, n=4000):
    """Spans of tokens in no order, and the lines of each of five steps."""
    spans = spark.range(n).selectExpr(
        "concat('token', lpad(cast(hash(id) & 65535 as string), 5, '0'), '_', id) AS token",
        "cast(id % 5 as int) AS first_step", "cast(4 - id % 3 as int) AS last_step", "id % 7 + 1 AS cnt",
    )
    spans.repartition(3).write.parquet(str(tmp_path / "spans"))
    found = spans.collect()
    return str(tmp_path / "spans"), [sorted((r[0], r[3]) for r in found if r[1] <= s <= r[2]) for s in range(5)]


@pytest.mark.parametrize("form", ["tsv", "tuple"])
@pytest.mark.parametrize("together", [2, 32])
def test_spans_are_spelled_out_in_key_order_by_few_jobs(spark, tmp_path, monkeypatch, form, together):
    monkeypatch.setattr(sinks_counts, "STEPS_TOGETHER", together)
    table, expected = spans_table(spark, tmp_path)
    sources, before = ["A", "B", "C", "D", "E"], spark.conf.getAll
    write_spans_by_range(spark, table, str(tmp_path / "out"), sources, form, "gzip")
    assert spark.conf.getAll == before
    for s, name in enumerate(sources):
        parts = []
        for path in sorted((tmp_path / "out" / f"range=A-{name}").glob("part-*")):
            assert path.name.endswith(".txt.gz")
            lines = gzip.decompress(path.read_bytes()).decode().splitlines()
            parts.append([tuple(x.strip("()").replace(",", "\t").split("\t")) for x in lines])
        assert all(part == sorted(part) for part in parts)
        assert sorted((k, int(n)) for part in parts for k, n in part) == expected[s]
        shape = r"\(\w+,\d+\)" if form == "tuple" else r"\w+\t\d+"
        assert spark.read.text(str(tmp_path / "out" / f"range=A-{name}")).where(~F.col("value").rlike(f"^{shape}$")).isEmpty()


def test_spans_are_read_once_for_all_steps(spark, tmp_path, monkeypatch):
    table, _ = spans_table(spark, tmp_path)
    reads, writer = [], type(spark.range(0).write)
    for name in ("text", "csv"):
        monkeypatch.setattr(writer, name, lambda self, path, *a, f=getattr(writer, name), **b: (reads.append(path), f(self, path, *a, **b)) and None)
    write_spans_by_range(spark, table, str(tmp_path / "out"), ["A", "B", "C", "D", "E"], "tsv", "gzip")
    assert len(reads) == 1


def test_a_step_without_rows_has_a_folder_and_ranges_are_never_mixed(spark, tmp_path):
    spans = spark.createDataFrame([("late", 2, 2, 5)], "token string, first_step int, last_step int, cnt bigint")
    spans.write.parquet(str(tmp_path / "spans"))
    write_spans_by_range(spark, str(tmp_path / "spans"), str(tmp_path / "out"), ["A#", "B", "C"], "tsv", "gzip")
    assert sorted(p.name for p in (tmp_path / "out").glob("range=*")) == ["range=A%23-A%23", "range=A%23-B", "range=A%23-C"]
    assert rows(spark.read.text(str(tmp_path / "out")).select("range", "value")) == [("A#-C", "late\t5")]
    with pytest.raises(AnalysisException):
        write_spans_by_range(spark, str(tmp_path / "spans"), str(tmp_path / "twice"), ["A", "A"], "tsv")


def test_tasks_that_count_pairs_get_small_splits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "COUNTED_MIB", 1)
    put(tmp_path / "c" / "AA" / "f.txt", "history museum 1234\n" * (3 << 16))
    before = spark.conf.getAll
    lines = read_sources(spark, str(tmp_path / "c"), ["AA"])
    assert lines.sparkSession is spark and spark.conf.getAll == before
    assert lines.select(F.spark_partition_id()).distinct().count() >= 3
    assert lines.distinct().collect() == [("history museum 1234", "AA")] and lines.count() == 3 << 16
