"""The registered queries in DuckDB SQL.

Written from the rules, not from the Spark code: text is split on the
separator and each piece is tested as a whole, and every step of a series is
counted on its own range of sources.
"""

from __future__ import annotations

from tallywork.functions import rules
from tallywork.plans.registry import COUNT_WANTED, MEANS_ROUNDED_TO, SOURCES

def _word(column: str) -> str:
    return f"regexp_full_match({column}, '{rules.WORD_PATTERN}')"


def _number(column: str) -> str:
    low, high = rules.NUMBER_MIN_LENGTH, rules.NUMBER_MAX_LENGTH
    return (
        f"(regexp_full_match({column}, '{rules.NUMBER_PATTERN}') "
        f"AND length({column}) BETWEEN {low} AND {high})"
    )


_SOURCE_LIST = ", ".join(f"'{name}'" for name in SOURCES)
_STEP = "CAST(regexp_extract(source, '[0-9]+$') AS INTEGER)"

_LINES = f"""
lines AS (
  SELECT doc_id, source, unnest(regexp_split_to_array(text, '{rules.LINE_END_PATTERN}')) AS value
  FROM documents)"""

_PIECES = f"""{_LINES},
pieces AS (
  SELECT doc_id, source,
         unnest(regexp_split_to_array(lower(value), '{rules.SEPARATOR_PATTERN}')) AS token
  FROM lines)"""

_TOKENS = f"""{_PIECES},
tokens AS (
  SELECT doc_id, source, token FROM pieces WHERE {_word('token')} OR {_number('token')})"""

_COUNTS = f"""{_TOKENS},
counts AS (SELECT token, count(*) AS cnt FROM tokens GROUP BY token)"""

_PAIRS = f"""{_LINES},
listed AS (
  SELECT doc_id, source, list_filter(
      regexp_split_to_array(lower(value), '{rules.SEPARATOR_PATTERN}'),
      lambda t: {_word('t')} OR {_number('t')}) AS toks
  FROM lines),
paired AS (
  SELECT doc_id, source, unnest(list_concat(
      list_transform(range(1, len(toks)), lambda i: {{'l': toks[i], 'r': toks[i + 1]}}),
      list_transform(range(1, len(toks) - 1), lambda i: {{'l': toks[i], 'r': toks[i + 2]}})
    )) AS pair
  FROM listed),
pairs AS (SELECT doc_id, source, pair.l AS "left", pair.r AS "right" FROM paired)"""

_PAIR_COUNTS = f"""{_PAIRS},
counts AS (SELECT "left", "right", count(*) AS cnt FROM pairs GROUP BY ALL)"""

_STEPS = f"""
steps AS (
  SELECT CAST(unnest(generate_series(0, (SELECT max({_STEP}) FROM documents))) AS INTEGER) AS step)"""

_STEP_COUNTS = f"""{_TOKENS},{_STEPS},
counts AS (
  SELECT step, token, count(*) AS cnt
  FROM steps JOIN tokens ON {_STEP} <= step GROUP BY ALL)"""

_STEP_PAIR_COUNTS = f"""{_PAIRS},{_STEPS},
counts AS (
  SELECT step, "left", "right", count(*) AS cnt
  FROM steps JOIN pairs ON {_STEP} <= step GROUP BY ALL)"""

_EVENTS = """
known AS (
  SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS value
  FROM events)"""

_MEDIAN = (
    f"(SELECT quantile_disc(coalesce(value, {rules.MISSING_VALUE_DEFAULT}.0), 0.5) FROM known)"
)

_BOTH_WORDS = f"{_word('\"left\"')} AND {_word('\"right\"')}"
_NUMBER_WORD = f"{_number('\"left\"')} AND {_word('\"right\"')}"


def _with(parts: str, select: str) -> str:
    return f"WITH {parts.strip()}\n{select}"


def _ranked(parts: str, keys: str, condition: str) -> str:
    return _with(
        parts,
        f"SELECT step, {keys}, cnt FROM counts WHERE {condition} "
        f"QUALIFY row_number() OVER (PARTITION BY step ORDER BY cnt DESC, {keys}) <= {rules.TOP_K}",
    )


_TOKEN_COUNTS = _with(_COUNTS, "SELECT token, cnt FROM counts")
_ALL_PAIR_COUNTS = _with(_PAIR_COUNTS, 'SELECT "left", "right", cnt FROM counts')
_TOP_WORDS = _with(
    _COUNTS,
    f"SELECT token, cnt FROM counts WHERE {_word('token')} "
    f"ORDER BY cnt DESC, token LIMIT {rules.TOP_K}",
)

_ORDERED = f"""
ordered AS (
  SELECT source, row_number() OVER (ORDER BY {_STEP}, source) - 1 AS step
  FROM (SELECT DISTINCT source FROM documents))"""

_RANGES = f"""{_ORDERED},
covered AS (
  SELECT (SELECT source FROM ordered WHERE step = 0) || '-' || whole.source AS "range",
         part.source AS source
  FROM ordered AS whole JOIN ordered AS part ON part.step <= whole.step)"""

_SERIES = _with(
    f"""{_PAIRS},{_RANGES},
tokens AS (SELECT source, unnest(toks) AS token FROM listed),
token_counts AS (
  SELECT "range", token, count(*) AS cnt FROM tokens JOIN covered USING (source) GROUP BY ALL),
pair_counts AS (
  SELECT "range", "left", "right", count(*) AS cnt
  FROM pairs JOIN covered USING (source) GROUP BY ALL),
top_words AS (
  SELECT "range", token, cnt FROM token_counts WHERE {_word('token')}
  QUALIFY row_number() OVER (PARTITION BY "range" ORDER BY cnt DESC, token) <= {rules.TOP_K}),
top_pairs AS (
  SELECT "range", "left", "right", cnt FROM pair_counts WHERE {_NUMBER_WORD}
  QUALIFY row_number() OVER (
    PARTITION BY "range" ORDER BY cnt DESC, "left", "right") <= {rules.TOP_K})""",
    f"""SELECT 'token_counts' AS job, "range", token AS key, cnt FROM token_counts
UNION ALL SELECT 'words_with_count', "range", token, cnt FROM token_counts
  WHERE {_word('token')} AND cnt = {COUNT_WANTED}
UNION ALL SELECT 'top_words', "range", token, cnt FROM top_words
UNION ALL SELECT 'pair_counts', "range", "left" || ':' || "right", cnt FROM pair_counts
UNION ALL SELECT 'word_pairs_with_count', "range", "left" || ':' || "right", cnt FROM pair_counts
  WHERE {_BOTH_WORDS} AND cnt = {COUNT_WANTED}
UNION ALL SELECT 'top_number_word_pairs', "range", "left" || ':' || "right", cnt FROM top_pairs""",
)

_SELECTIONS = _with(
    f"""{_PAIRS},
token_counts AS (
  SELECT token, count(*) AS cnt FROM (SELECT unnest(toks) AS token FROM listed) GROUP BY token),
pair_counts AS (SELECT "left", "right", count(*) AS cnt FROM pairs GROUP BY ALL),
top_words AS (
  SELECT token, cnt FROM token_counts WHERE {_word('token')}
  ORDER BY cnt DESC, token LIMIT {rules.TOP_K}),
top_pairs AS (
  SELECT "left", "right", cnt FROM pair_counts WHERE {_NUMBER_WORD}
  ORDER BY cnt DESC, "left", "right" LIMIT {rules.TOP_K})""",
    f"""SELECT 'words_with_count' AS job, token AS key, cnt FROM token_counts
  WHERE {_word('token')} AND cnt = {COUNT_WANTED}
UNION ALL SELECT 'top_words', token, cnt FROM top_words
UNION ALL SELECT 'word_pairs_with_count', "left" || ':' || "right", cnt FROM pair_counts
  WHERE {_BOTH_WORDS} AND cnt = {COUNT_WANTED}
UNION ALL SELECT 'top_number_word_pairs', "left" || ':' || "right", cnt FROM top_pairs""",
)

ORACLE: dict[str, str] = {
    "scan_lines": _with(_LINES, "SELECT value FROM lines"),
    "scan_lines_recursive": _with(_LINES, "SELECT value FROM lines"),
    "scan_source_subset": _with(
        _LINES, f"SELECT value, source FROM lines WHERE source IN ({_SOURCE_LIST})"
    ),
    "read_counts_tsv": _ALL_PAIR_COUNTS,
    "read_counts_tuple": _ALL_PAIR_COUNTS,
    "read_csv_table": (
        "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, "
        "c_mktsegment FROM customer"
    ),
    "write_counts_tsv": _TOKEN_COUNTS,
    "write_counts_tuple": _TOKEN_COUNTS,
    "write_topk": _TOP_WORDS,
    "write_layout": _with(
        f"""{_COUNTS},{_ORDERED},
outputs AS (
  SELECT 'token_counts' AS job, token AS key, cnt FROM counts
  UNION ALL
  SELECT 'words_with_count', token, cnt FROM counts
  WHERE {_word('token')} AND cnt = {COUNT_WANTED})""",
        """SELECT job, (SELECT min_by(source, step) || '-' || max_by(source, step) FROM ordered) AS "range",
       key, cnt FROM outputs""",
    ),
    "read_odd_counts": f"""
SELECT 'doc' || CAST(doc_id AS VARCHAR) AS token,
       CASE doc_id % 8 WHEN 2 THEN {2**63 - 1} WHEN 4 THEN CAST('{-(2**63)}' AS BIGINT) ELSE doc_id END AS cnt
FROM documents WHERE doc_id % 8 NOT IN (3, 5, 6)""".strip(),
    "select_from_counts_tsv": _SELECTIONS,
    "select_from_counts_tuple": _SELECTIONS,
    "write_series": _SERIES,
    "tokenize": _with(
        _LINES,
        "SELECT doc_id, array_to_string("
        f"regexp_split_to_array(lower(value), '{rules.SEPARATOR_PATTERN}'), ' ') AS tokens "
        "FROM lines",
    ),
    "token_kind": (
        "WITH pieces AS (SELECT unnest(regexp_split_to_array(lower(text), "
        f"'{rules.SEPARATOR_PATTERN}')) AS token FROM documents) "
        f"SELECT token, CASE WHEN {_word('token')} THEN 'word' WHEN {_number('token')} "
        "THEN 'number' END AS kind, count(*) AS cnt FROM pieces GROUP BY token"
    ),
    "accepted_tokens": _with(_TOKENS, "SELECT doc_id, token FROM tokens"),
    "pair_key": _with(_PAIR_COUNTS, "SELECT \"left\" || ':' || \"right\" AS pair, cnt FROM counts"),
    "pair_split": _ALL_PAIR_COUNTS,
    "parse_count": _with(
        _PIECES,
        "SELECT doc_id, token, TRY_CAST(token AS BIGINT) AS parsed FROM pieces "
        "WHERE regexp_full_match(token, '[+-]?[0-9]+') AND TRY_CAST(token AS BIGINT) IS NOT NULL",
    ),
    "null_default": _with(
        _EVENTS,
        f"SELECT event_id, coalesce(value, {rules.MISSING_VALUE_DEFAULT}.0) AS value FROM known",
    ),
    "words_only": _with(_COUNTS, f"SELECT token, cnt FROM counts WHERE {_word('token')}"),
    "word_word_pairs": _with(
        _PAIR_COUNTS, f'SELECT "left", "right", cnt FROM counts WHERE {_BOTH_WORDS}'
    ),
    "number_word_pairs": _with(
        _PAIR_COUNTS, f'SELECT "left", "right", cnt FROM counts WHERE {_NUMBER_WORD}'
    ),
    "count_equals": _with(_COUNTS, f"SELECT token, cnt FROM counts WHERE cnt = {COUNT_WANTED}"),
    "above_scalar": _with(
        _EVENTS,
        "SELECT event_id, user_id, value FROM known WHERE value > "
        "(SELECT avg(value) FROM events WHERE event_type = 'signup')",
    ),
    "token_pairs": _with(_PAIRS, 'SELECT doc_id, "left", "right" FROM pairs'),
    "token_counts": _TOKEN_COUNTS,
    "pair_counts": _ALL_PAIR_COUNTS,
    "words_with_count": _with(
        _COUNTS, f"SELECT token, cnt FROM counts WHERE {_word('token')} AND cnt = {COUNT_WANTED}"
    ),
    "word_pairs_with_count": _with(
        _PAIR_COUNTS,
        f'SELECT "left", "right", cnt FROM counts WHERE {_BOTH_WORDS} AND cnt = {COUNT_WANTED}',
    ),
    "top_words": _TOP_WORDS,
    "top_number_word_pairs": _with(
        _PAIR_COUNTS,
        f'SELECT "left", "right", cnt FROM counts WHERE {_NUMBER_WORD} '
        f'ORDER BY cnt DESC, "left", "right" LIMIT {rules.TOP_K}',
    ),
    "prefix_token_counts": _with(_STEP_COUNTS, "SELECT step, token, cnt FROM counts"),
    "prefix_pair_counts": _with(
        _STEP_PAIR_COUNTS, 'SELECT step, "left", "right", cnt FROM counts'
    ),
    "prefix_words_with_count": _with(
        _STEP_COUNTS,
        f"SELECT step, token, cnt FROM counts WHERE {_word('token')} AND cnt = {COUNT_WANTED}",
    ),
    "prefix_word_pairs_with_count": _with(
        _STEP_PAIR_COUNTS,
        f'SELECT step, "left", "right", cnt FROM counts '
        f"WHERE {_BOTH_WORDS} AND cnt = {COUNT_WANTED}",
    ),
    "prefix_top_words": _ranked(_STEP_COUNTS, "token", _word("token")),
    "prefix_top_number_word_pairs": _ranked(_STEP_PAIR_COUNTS, '"left", "right"', _NUMBER_WORD),
    "median_exact": _with(_EVENTS, f"SELECT {_MEDIAN} AS median"),
    "median_approx_rank": _with(_EVENTS, "SELECT count(*) AS n_values, TRUE AS is_near FROM known"),
    "above_median": _with(
        _EVENTS, f"SELECT event_id, user_id FROM known WHERE value > {_MEDIAN} ORDER BY event_id"
    ),
    "above_median_count": _with(
        _EVENTS, f"SELECT count(*) AS cnt FROM known WHERE value > {_MEDIAN}"
    ),
    "group_mean": (
        f"SELECT o_orderstatus, round(avg(o_totalprice), {MEANS_ROUNDED_TO}) AS mean "
        "FROM orders GROUP BY o_orderstatus ORDER BY o_orderstatus"
    ),
    "group_mean_gap": f"""
WITH means AS (
  SELECT avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS first_mean,
         avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS second_mean
  FROM orders)
SELECT round(first_mean, {MEANS_ROUNDED_TO}) AS first_mean,
       round(second_mean, {MEANS_ROUNDED_TO}) AS second_mean,
       round(abs(first_mean - second_mean), {MEANS_ROUNDED_TO}) AS gap,
       CASE WHEN abs(first_mean - second_mean) < {rules.GAP_LIMIT}
            THEN '{rules.SMALL_GAP_VERDICT}'
            WHEN abs(first_mean - second_mean) >= {rules.GAP_LIMIT}
            THEN '{rules.LARGE_GAP_VERDICT}' END AS verdict
FROM means""".strip(),
}
