"""Token and pair rules, against goldens and a plain Python model."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywork import functions as fn
from tallywork.functions import rules
from tallywork.operators.counts import count_pairs, count_tokens
from tallywork.operators.select import number_word_pairs, word_word_pairs
from tallywork.operators.tokens import explode_pairs, explode_tokens
from tallywork.sources import split_lines

FIRST = (
    "Wikipedia: the FREE encyclopedia, 2001-2024; since 1,234 or 3.14159 "
    "articles-about history history"
)
SECOND = (
    "-1999 999 12345678901234567 1234567890123456 1,234,567 1990. ______ abcde -abcdef "
    "abcdefghijklmnopqrstuvwxy abcdefghijklmnopqrstuvwx abc123def café-society don't-mention"
)
FIRST_TOKENS = ["wikipedia", "1,234", "3.14159", "articles-about", "history", "history"]
SECOND_TOKENS = [
    "-1999",
    "1234567890123456",
    "______",
    "-abcdef",
    "abcdefghijklmnopqrstuvwx",
    "-society",
    "t-mention",
]


def corpus(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def model_tokens(line):
    pieces = re.split(r"[^a-z0-9.,_\-]+", line.lower())
    return [
        p
        for p in pieces
        if re.fullmatch(r"[a-z_\-]{6,24}", p)
        or (re.fullmatch(r"-?[0-9]+([.,][0-9]+)?", p) and 4 <= len(p) <= 16)
    ]


def model_pairs(line, window=2):
    kept = model_tokens(line)
    return [
        (kept[i], kept[i + d])
        for i in range(len(kept))
        for d in range(1, window + 1)
        if i + d < len(kept)
    ]


def test_accepted_tokens_of_each_line(spark):
    lines = [FIRST, SECOND, "single-token", "", None]
    df = corpus(spark, lines).select(fn.accepted_tokens(F.col("value")).alias("t"))
    assert [r.t for r in df.collect()] == [FIRST_TOKENS, SECOND_TOKENS, ["single-token"], [], None]
    assert explode_tokens(corpus(spark, lines)).count() == 14


def test_pairs_of_the_first_line(spark):
    counts = count_pairs(explode_pairs(corpus(spark, [FIRST, "single-token", "", None])))
    assert {(r.left, r.right): r.cnt for r in counts.collect()} == {
        ("wikipedia", "1,234"): 1,
        ("1,234", "3.14159"): 1,
        ("3.14159", "articles-about"): 1,
        ("articles-about", "history"): 2,
        ("history", "history"): 1,
        ("wikipedia", "3.14159"): 1,
        ("1,234", "articles-about"): 1,
        ("3.14159", "history"): 1,
    }
    assert {(r.left, r.right) for r in number_word_pairs(counts).collect()} == {
        ("3.14159", "articles-about"),
        ("1,234", "articles-about"),
        ("3.14159", "history"),
    }
    for accepted in (False, True):
        assert {(r.left, r.right) for r in word_word_pairs(counts, accepted).collect()} == {
            ("articles-about", "history"),
            ("history", "history"),
        }


def test_pairs_never_cross_lines(spark):
    text = spark.createDataFrame([(1, "alphas\r\nbetass gammas\ndeltas\repsilon")], "id int, text string")
    lines = split_lines(text)
    assert [r.value for r in lines.collect()] == ["alphas", "betass gammas", "deltas", "epsilon"]
    assert [(r.id, r.left, r.right) for r in explode_pairs(lines).collect()] == [
        (1, "betass", "gammas")
    ]


def test_lines_of_null_and_empty_text(spark):
    text = spark.createDataFrame([(None,), ("",), ("a\n",)], "text string")
    assert [r.value for r in split_lines(text).collect()] == ["", "a", ""]


def test_kind_is_word_or_number_or_null(spark):
    tokens = ["history", "short", "1234", "999", "history,", "1990.", "-1999", "______", "abcdef\n"]
    df = corpus(spark, tokens).select(fn.token_kind(F.col("value")).alias("kind"))
    assert [r.kind for r in df.collect()] == [
        "word", None, "number", None, None, None, "number", "word", None,
    ]


def test_pair_key_and_parts(spark):
    df = corpus(spark, ["a:b", "a", "a:b:c", "a:", ":b"])
    parts = df.select(fn.pair_parts(F.col("value")).alias("p")).collect()
    assert [tuple(r.p) if r.p else None for r in parts] == [("a", "b"), None, None, None, ("", "b")]
    key = df.select(fn.pair_key(F.lit("1,234"), F.lit("history")).alias("k")).first().k
    assert key == "1,234:history"


def test_parse_count(spark):
    texts = ["1000", " 7\t", "+5", "-3", "x", "", "1.0", "1e3", "99999999999", "9" * 30, None]
    df = corpus(spark, texts).select(fn.parse_count(F.col("value")).alias("n"))
    assert [r.n for r in df.collect()] == [
        1000, 7, 5, -3, None, None, None, None, 99999999999, None, None,
    ]


def test_wider_windows(spark):
    line = "alphas betass gammas deltas epsilon"
    for window in (1, 2, 3, 4, 9):
        rows = explode_pairs(corpus(spark, [line]), window=window).collect()
        assert Counter((r.left, r.right) for r in rows) == Counter(model_pairs(line, window))


PIECES = st.sampled_from(
    ["history", "a", "-", "_", "1", "1234", ",", ".", "é", "İ", "K", "'", " ", "\t", "abcdef",
     "-1999", "1,234", "zzzzzzzzzzzzzzzzzzzzzzzz", "1234567890123456", "ß", "日本", "Σ"]
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=40).map("".join), min_size=20, max_size=60))
def test_any_text_gives_the_tokens_and_pairs_of_the_model(spark, lines):
    df = corpus(spark, lines).repartition(3)
    tokens = {r.token: r.cnt for r in count_tokens(explode_tokens(df)).collect()}
    assert tokens == Counter(t for line in lines for t in model_tokens(line))
    pairs = {(r.left, r.right): r.cnt for r in count_pairs(explode_pairs(df)).collect()}
    assert pairs == Counter(p for line in lines for p in model_pairs(line))


def test_pieces_are_those_of_the_separator_pattern(spark):
    texts = [FIRST, SECOND, "", " a", "a ", "é", "a\nb\r\nc\u2028d\U0001f600e", " \t,", None]
    df = corpus(spark, texts)
    plain = F.split(F.lower("value"), rules.SEPARATOR_PATTERN, -1)
    for row in df.select(fn.tokens(F.col("value")).alias("a"), plain.alias("b")).collect():
        assert row.a == row.b


def test_very_long_runs(spark):
    n = 2_000_000
    text = "日" * n + "history" + "x" * n + " " * n + "museum" + "😀" * n
    df = corpus(spark, [text])
    assert [len(t) for t in df.select(fn.tokens(F.col("value")).alias("t")).first().t] == [
        0, 7 + n, 6, 0,
    ]
    assert df.select(fn.accepted_tokens(F.col("value")).alias("t")).first().t == ["museum"]


def test_number_of_pairs_follows_from_the_tokens_per_line(spark):
    lines = corpus(spark, [FIRST, SECOND, "one-token", "", FIRST])
    n = F.size(fn.accepted_tokens(F.col("value")))
    expected = lines.select(
        F.sum(F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))).alias("n")
    ).first().n
    assert explode_pairs(lines).count() == expected
