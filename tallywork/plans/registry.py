"""The registered queries: each takes a session and a directory of tables.

The corpus is the ``documents`` table. Its sections are the values of
``source``, in the order of the number at their end. For the table queries,
``events.value`` counts as missing for events of type ``error``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork import functions as fn
from tallywork.functions import rules
from tallywork.operators import counts as cnt
from tallywork.operators import prefix, select, stats, tokens
from tallywork.plans import jobs
from tallywork.session import in_small_splits, remove_path, scratch_path, text_partitions
from tallywork.sinks import write_counts, write_top
from tallywork.sources import (
    dealt,
    read_csv_table,
    read_lines,
    read_pair_counts,
    read_sources,
    read_token_counts,
    split_lines,
)

# No token of the test tables has the count 1000, so these queries ask for 3.
COUNT_WANTED = 3
# The sources of the subset query.
SOURCES = [f"src{i}" for i in range(11)]
MEANS_ROUNDED_TO = 4

Query = Callable[[SparkSession, str], DataFrame]


# The inputs.


def documents(spark: SparkSession, sf_dir: str, *others: str) -> DataFrame:
    def read(session: SparkSession) -> DataFrame:
        return session.read.parquet(f"{sf_dir}/documents.parquet").select("text", *others)

    return dealt(in_small_splits(spark, read), text_partitions(spark))


def lines(spark: SparkSession, sf_dir: str, *others: str) -> DataFrame:
    return split_lines(documents(spark, sf_dir, *others))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    known = F.when(F.col("event_type") != "error", F.col("value"))
    return table.select("event_id", "user_id", known.alias("value"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def source_step(source: Column) -> Column:
    return F.regexp_extract(source, "[0-9]+$", 0).cast("int")


def last_step(spark: SparkSession, sf_dir: str) -> Column:
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return table.agg(F.max(source_step(F.col("source")))).scalar()


def source_names(spark: SparkSession, sf_dir: str) -> list[str]:
    """The directories of all sources, in order of the number at their end."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("source").isNotNull())
    rows = table.select("source").distinct().orderBy(source_step(F.col("source")), "source").collect()
    return [f"source={row.source}" for row in rows]


def nested_corpus(spark: SparkSession, sf_dir: str) -> str:
    """The corpus as text files two plain folders down; returns the upper one."""
    path = scratch_path(spark, "nested")
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("text").isNotNull())
    table.select("text").write.text(f"{path}/upper/lower")
    return path


def written_corpus(spark: SparkSession, sf_dir: str) -> str:
    """The corpus as text files in one directory per source; returns its path."""
    path = scratch_path(spark, "corpus")
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("text").isNotNull())
    # Rebalancing gives each source whole files of a fair size and splits a
    # large source over several tasks.
    rows = table.select("text", "source").hint("rebalance", "source")
    rows.write.partitionBy("source").text(path)
    return path


# Sources.


def scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lines(spark, f"{written_corpus(spark, sf_dir)}/source=*").select("value")


def scan_lines_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lines(spark, nested_corpus(spark, sf_dir), recursive=True).select("value")


def scan_source_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"source={name}" for name in SOURCES]
    rows = read_sources(spark, written_corpus(spark, sf_dir), names)
    return rows.select("value", F.substring_index("source", "=", -1).alias("source"))


def _token_counts_reread(form: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"token_counts_{form}")
        write_counts(token_counts(spark, sf_dir), path, form)
        return read_token_counts(spark, path, form)

    return query


def _pair_counts_reread(form: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, f"pair_counts_{form}")
        write_counts(pair_counts(spark, sf_dir), path, form)
        return read_pair_counts(spark, path, form)

    return query


def csv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer_csv")
    spark.read.parquet(f"{sf_dir}/customer.parquet").write.option("header", True).csv(path)
    return read_csv_table(spark, path)


# Sinks.


def write_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "top_words")
    write_top(top_words(spark, sf_dir), path, k=rules.TOP_K)
    return read_token_counts(spark, path)


def write_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus, out = written_corpus(spark, sf_dir), scratch_path(spark, "layout")
    names = source_names(spark, sf_dir)
    jobs.run_count_job(spark, "token_counts", corpus, names, out)
    jobs.run_select_job(spark, "words_with_count", names, out, limit=COUNT_WANTED)
    return _read_layout(spark, out)


def write_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus, out = written_corpus(spark, sf_dir), scratch_path(spark, "series")
    names = source_names(spark, sf_dir)
    jobs.run_series(spark, corpus, names, out, n=COUNT_WANTED, compression="gzip")
    remove_path(spark, corpus)
    return _read_layout(spark, out)


def _selections_reread(form: str) -> Query:
    """All four selections, each from the persisted counts of all sources."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out, read = scratch_path(spark, f"selections_{form}"), None
        names = source_names(spark, sf_dir)
        corpus = written_corpus(spark, sf_dir)
        for parent in jobs.COUNT_JOBS:
            jobs.run_count_job(spark, parent, corpus, names, out, form)
        for name, job in jobs.SELECT_JOBS.items():
            limit = None if job.is_top else COUNT_WANTED
            path = jobs.run_select_job(spark, name, names, out, form, limit)
            if job.parent == "token_counts":
                rows = read_token_counts(spark, path, form).select(F.col("token").alias("key"), "cnt")
            else:
                rows = read_pair_counts(spark, path, form)
                rows = rows.select(fn.pair_key(F.col("left"), F.col("right")).alias("key"), "cnt")
            rows = rows.select(F.lit(name).alias("job"), "key", "cnt")
            read = rows if read is None else read.unionByName(rows)
        return read

    return query


def read_odd_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count lines reread of which some do not fit: one line per document, in turn."""
    doc_id = F.col("doc_id").cast("string")
    counts = [
        doc_id, F.lpad(doc_id, 30, "0"), F.lit(str(2**63 - 1)), F.lit(str(2**63)), F.lit(str(-(2**63))),
        F.concat(F.lit("x"), doc_id), F.concat(doc_id, F.lit("\t1")), F.concat(F.lit("+"), doc_id),
    ]
    kind = F.pmod(F.col("doc_id"), F.lit(len(counts))).cast("int")
    line = F.concat(F.lit("doc"), doc_id, F.lit("\t"), F.get(F.array(*counts), kind))
    path = scratch_path(spark, "odd_counts")
    spark.read.parquet(f"{sf_dir}/documents.parquet").select(line.alias("value")).write.text(path)
    return read_token_counts(spark, path)


def _read_layout(spark: SparkSession, out: str) -> DataFrame:
    # A line has one tab. Cut there, it need not be turned into an array first.
    key, cnt = (F.substring_index("value", "\t", n) for n in (1, -1))
    return spark.read.text(out).select("job", "range", key.alias("key"), cnt.cast("bigint").alias("cnt"))


# Projections and predicates.


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Tokens hold no blank, so joining them with blanks loses nothing.
    joined = F.array_join(fn.tokens(F.col("value")), " ")
    return lines(spark, sf_dir, "doc_id").select("doc_id", joined.alias("tokens"))


def token_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    pieces = docs.select(F.explode(fn.tokens(F.col("text"))).alias("token"))
    counted = cnt.count_tokens(pieces)
    return counted.select("token", fn.token_kind(F.col("token")).alias("kind"), "cnt")


def accepted_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.explode_tokens(documents(spark, sf_dir, "doc_id"), "text")


def pair_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = fn.pair_key(F.col("left"), F.col("right")).alias("pair")
    return pair_counts(spark, sf_dir).select(key, "cnt")


def pair_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fn.pair_parts(F.col("pair")).alias("parts")
    split = pair_key(spark, sf_dir).select(parts, "cnt").where(F.col("parts").isNotNull())
    return split.select("parts.left", "parts.right", "cnt")


def parse_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id")
    pieces = docs.select("doc_id", F.explode(fn.tokens(F.col("text"))).alias("token"))
    parsed = pieces.select("doc_id", "token", fn.parse_count(F.col("token")).alias("parsed"))
    return parsed.where(F.col("parsed").isNotNull())


def null_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = fn.null_default(F.col("value")).alias("value")
    return events(spark, sf_dir).select("event_id", value)


def words_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.words_only(token_counts(spark, sf_dir))


def word_word_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.word_word_pairs(pair_counts(spark, sf_dir), accepted=True)


def number_word_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.number_word_pairs(pair_counts(spark, sf_dir))


def count_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.count_equals(token_counts(spark, sf_dir), COUNT_WANTED)


def above_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The scalar here is the mean value of one event type.
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    signup_mean = table.where(F.col("event_type") == "signup").agg(F.avg("value"))
    return stats.above_scalar(events(spark, sf_dir), "value", signup_mean)


# The corpus jobs.


def token_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.explode_pairs(lines(spark, sf_dir, "doc_id"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cnt.count_tokens(tokens.explode_tokens(documents(spark, sf_dir), "text"))


def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cnt.count_pairs(tokens.explode_pairs(lines(spark, sf_dir)))


def words_with_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.words_with_count(token_counts(spark, sf_dir), COUNT_WANTED)


def word_pairs_with_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.word_pairs_with_count(pair_counts(spark, sf_dir), COUNT_WANTED, accepted=True)


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.top_words(token_counts(spark, sf_dir))


def top_number_word_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.top_number_word_pairs(pair_counts(spark, sf_dir))


# The same for a growing series of sources.


def token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "source")
    docs = docs.select("text", source_step(F.col("source")).alias("step"))
    return prefix.token_spans(tokens.explode_tokens(docs, "text"), last_step(spark, sf_dir))


def pair_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, "source")
    rows = rows.select("value", source_step(F.col("source")).alias("step"))
    return prefix.pair_spans(tokens.explode_pairs(rows), last_step(spark, sf_dir))


def prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix.by_step(token_spans(spark, sf_dir))


def prefix_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix.by_step(pair_spans(spark, sf_dir))


def prefix_words_with_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix.prefix_words_with_count(token_spans(spark, sf_dir), COUNT_WANTED)


def prefix_word_pairs_with_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix.prefix_word_pairs_with_count(pair_spans(spark, sf_dir), COUNT_WANTED, accepted=True)


def prefix_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix.prefix_top_words(token_spans(spark, sf_dir))


def prefix_top_number_word_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix.prefix_top_number_word_pairs(pair_spans(spark, sf_dir))


# The table jobs.


def median_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.median_exact(events(spark, sf_dir), "value")


def median_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.median_approx(events(spark, sf_dir), "value")


def median_approx_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values there are, and whether the approximate median's rank is close enough."""
    values = events(spark, sf_dir).select(fn.null_default(F.col("value")).alias("value"))
    found = values.withColumn("found", median_approx(spark, sf_dir).scalar())
    seen = found.agg(
        F.count("value").alias("n_values"),
        F.count_if(F.col("value") < F.col("found")).alias("below"),
        F.count_if(F.col("value") <= F.col("found")).alias("up_to"),
    )
    middle, slack = F.col("n_values") / 2, rules.MEDIAN_RELATIVE_ERROR * F.col("n_values")
    near = (F.col("below") - slack <= middle) & (F.col("up_to") + slack >= middle)
    return seen.select("n_values", near.alias("is_near"))


def above_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    median = median_exact(spark, sf_dir)
    return stats.above_median(events(spark, sf_dir), "value", "event_id", "user_id", median)


def above_median_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.row_count(
        stats.above_scalar(events(spark, sf_dir), "value", median_exact(spark, sf_dir))
    )


def group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = stats.group_mean(orders(spark, sf_dir), "o_orderstatus", "o_totalprice")
    return means.withColumn("mean", F.round("mean", MEANS_ROUNDED_TO))


def group_mean_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = stats.group_mean_gap(orders(spark, sf_dir), "o_orderstatus", "o_totalprice", "F", "O")
    rounded = {
        name: F.round(name, MEANS_ROUNDED_TO) for name in ("first_mean", "second_mean", "gap")
    }
    return gap.withColumns(rounded)


QUERIES: dict[str, Query] = {
    "scan_lines": scan_lines,
    "scan_lines_recursive": scan_lines_recursive,
    "scan_source_subset": scan_source_subset,
    "read_counts_tsv": _pair_counts_reread("tsv"),
    "read_counts_tuple": _pair_counts_reread("tuple"),
    "read_csv_table": csv_table,
    "write_counts_tsv": _token_counts_reread("tsv"),
    "write_counts_tuple": _token_counts_reread("tuple"),
    "write_topk": write_topk,
    "write_layout": write_layout,
    "write_series": write_series,
    "read_odd_counts": read_odd_counts,
    "select_from_counts_tsv": _selections_reread("tsv"),
    "select_from_counts_tuple": _selections_reread("tuple"),
    "tokenize": tokenize,
    "token_kind": token_kind,
    "accepted_tokens": accepted_tokens,
    "pair_key": pair_key,
    "pair_split": pair_split,
    "parse_count": parse_count,
    "null_default": null_default,
    "words_only": words_only,
    "word_word_pairs": word_word_pairs,
    "number_word_pairs": number_word_pairs,
    "count_equals": count_equals,
    "above_scalar": above_scalar,
    "token_pairs": token_pairs,
    "token_counts": token_counts,
    "pair_counts": pair_counts,
    "words_with_count": words_with_count,
    "word_pairs_with_count": word_pairs_with_count,
    "top_words": top_words,
    "top_number_word_pairs": top_number_word_pairs,
    "prefix_token_counts": prefix_token_counts,
    "prefix_pair_counts": prefix_pair_counts,
    "prefix_words_with_count": prefix_words_with_count,
    "prefix_word_pairs_with_count": prefix_word_pairs_with_count,
    "prefix_top_words": prefix_top_words,
    "prefix_top_number_word_pairs": prefix_top_number_word_pairs,
    "median_exact": median_exact,
    "median_approx": median_approx,
    "median_approx_rank": median_approx_rank,
    "above_median": above_median,
    "above_median_count": above_median_count,
    "group_mean": group_mean,
    "group_mean_gap": group_mean_gap,
}
