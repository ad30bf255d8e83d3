"""Queries that SQL can express, in DuckDB SQL, written from their rules."""

from __future__ import annotations

from tallywork.llm import licenses

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

# Excess is shared out again until no target is above its limit, which a
# recursive query does round by round. A document gets one more copy if the
# sizes up to its point still fit into what whole copies leave of the target,
# or if the sum with its point is nearer to that than the sum without.
_MIXING = f"""
WITH RECURSIVE items AS (
  SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS point
  FROM documents),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM items GROUP BY source),
sources AS (
  SELECT source, source_size, CAST(source_size * 3 AS DOUBLE) AS most,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM named),
rounds AS (
  SELECT 0 AS round, source, source_size, weight, most, FALSE AS fixed,
         sum(CAST(source_size AS DOUBLE)) OVER () * weight / sum(weight) OVER () AS target
  FROM sources
  UNION ALL
  SELECT round + 1, source, source_size, weight, most, fixed OR target > most,
         CASE WHEN fixed OR target > most THEN most
              ELSE (sum(CAST(source_size AS DOUBLE)) OVER ()
                    - sum(CASE WHEN fixed OR target > most THEN most ELSE 0 END) OVER ()) * weight
                   / sum(CASE WHEN fixed OR target > most THEN 0 ELSE weight END) OVER () END
  FROM rounds
  WHERE round <= (SELECT count(*) FROM sources)),
targets AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM rounds WHERE round = (SELECT max(round) FROM rounds)),
placed AS (
  SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS rest,
         sum(size) OVER (PARTITION BY i.source ORDER BY point
                         RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached,
         sum(size) OVER (PARTITION BY i.source, point) AS held
  FROM items i JOIN targets t ON i.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(size * (whole + CASE WHEN rest > 0 AND (reached <= rest OR reached - rest < rest - (reached - held))
                                 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed"""

# Record by record, without a tree.
_AUDIT = """
WITH records AS (
  SELECT page_id, html, CAST(floor(page_id / 256) AS BIGINT) AS file,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
         || 'WARC-Record-ID: <urn:page:' || CAST(page_id AS VARCHAR) || '>' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
         || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR)
         || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
         || chr(13) || chr(10) || chr(13) || chr(10) AS data
  FROM pages),
placed AS (
  SELECT *, length(coalesce(html, '')) % 41 AS rest,
         CAST(coalesce(sum(strlen(data)) OVER (PARTITION BY file ORDER BY page_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM records)
SELECT file, "offset", CASE rest WHEN 0 THEN 'changed' ELSE 'missing' END AS status,
       sha256(data) AS expected,
       CASE rest WHEN 0 THEN sha256(left(data, length(data) - 1) || '!') END AS found
FROM placed WHERE rest IN (0, 1)"""

_LISTED = ",\n  ".join(
    f"({n}, '{label}', {str(base).upper()}, '{text}')"
    for n, (label, text, base) in enumerate(
        [(label, text, True) for label, text in licenses.BASE_PHRASES]
        + [(label, text, False) for label, text in licenses.TEMPLATES]
    )
)

# Rows are told apart by their place in the table. A template of n words has
# n - 2 runs of three; a band is a diagonal and those above it, as many as
# words may be added.
_LICENSES = f"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
listed(template, label, is_base, told) AS (VALUES
  {_LISTED}),
templates AS (SELECT *, string_split(told, ' ') AS w FROM listed),
known AS (
  SELECT template, label, is_base, len(w) - 2 AS n_runs,
         CASE WHEN is_base THEN 0
              ELSE CAST(floor(len(w) * {licenses.ADDED_SHARE}) AS BIGINT) + {licenses.ADDED_WORDS} END AS reach,
         i - 1 AS q, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM templates)),
runs AS (
  SELECT n, i - 1 AS place, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM docs)
  WHERE w[i] IN (SELECT a FROM known)),
hits AS (
  SELECT n, template, label, is_base, n_runs, reach, place - q AS diagonal, place, q FROM runs JOIN known USING (a, b, c)),
bands AS (
  SELECT n, label, is_base, d.diagonal AS first_word, count(DISTINCT h.q)::DOUBLE / n_runs AS share
  FROM (SELECT DISTINCT n, template, label, is_base, n_runs, reach, diagonal FROM hits) d
  JOIN hits h USING (n, template, label, is_base, n_runs, reach)
  WHERE h.diagonal BETWEEN d.diagonal AND d.diagonal + d.reach
  GROUP BY n, template, label, is_base, n_runs, d.diagonal),
found AS (SELECT * FROM bands WHERE share >= CASE WHEN is_base THEN 1 ELSE {licenses.LEAST_SCORE} END),
summed AS (
  SELECT n, count(*) FILTER (WHERE is_base) AS n_base,
         min(first_word) FILTER (WHERE is_base) AS first_word, max(first_word) FILTER (WHERE is_base) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE is_base)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score
  FROM found GROUP BY n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0::DOUBLE) AS score
FROM docs LEFT JOIN summed USING (n)"""

# A tree is built level by level, and a proof level by level again, without
# jumps. The lowest bit of a crc32 comes from its rule, bit by bit. The null
# group is named "", the others have a stroke before their name.
_HASH_FIELDS = " || ".join(
    f"coalesce(CAST(strlen(CAST({f} AS VARCHAR)) AS VARCHAR) || ':' || CAST({f} AS VARCHAR), '-')"
    for f in ("doc_id", "source", "lang", "n_chars", "{text}")
)
_CRC_EVEN = """xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                 lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda x, y: xor(xor(x, y) >> 1, (xor(x, y) & 1) * 3988292384)), 4294967295) & 1 = 0"""
_LEVELS = """
  SELECT tree, 0 AS level, spot, held, digest, CAST(NULL AS VARCHAR[]) AS children FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, spot // 3, CAST(any_value(ceil(held / 3)) AS BIGINT),
         sha256(string_agg(digest, '' ORDER BY spot)), list(digest ORDER BY spot)
  FROM {name} WHERE held > 1 GROUP BY tree, level, spot // 3"""
_MANIFEST = f"""
WITH RECURSIVE rows AS (
  SELECT *, coalesce('/' || source, '') AS tree, sha256({_HASH_FIELDS.format(text="text")}) AS digest,
         CASE WHEN coalesce({_CRC_EVEN}, FALSE) THEN replace(text, chr(10), '') ELSE text END AS told
  FROM documents),
leaves AS (
  SELECT doc_id, tree, digest, sha256({_HASH_FIELDS.format(text="told")}) AS tampered,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS spot,
         count(*) OVER (PARTITION BY tree) AS held
  FROM rows),
levels AS ({_LEVELS.format(leaves="leaves", name="levels")}),
subroots AS (
  SELECT 'top' AS tree, tree AS below, digest, row_number() OVER (ORDER BY tree) - 1 AS spot, count(*) OVER () AS held
  FROM levels WHERE held = 1),
tops AS ({_LEVELS.format(leaves="subroots", name="tops")}),
paths AS (
  SELECT doc_id, digest AS leaf, tampered, l.tree AS below, l.tree, 0 AS level, l.spot, '' AS told, tampered AS folded
  FROM leaves l
  UNION ALL
  SELECT doc_id, leaf, tampered, p.below,
         CASE WHEN n.tree IS NULL THEN 'top' ELSE p.tree END, CASE WHEN n.tree IS NULL THEN 0 ELSE p.level + 1 END,
         CASE WHEN n.tree IS NULL THEN s.spot ELSE p.spot // 3 END,
         CASE WHEN n.tree IS NULL THEN told
              ELSE told || array_to_string(children[:p.spot % 3] || children[p.spot % 3 + 2:], '') END,
         CASE WHEN n.tree IS NULL THEN folded
              ELSE sha256(array_to_string(children[:p.spot % 3] || [folded] || children[p.spot % 3 + 2:], '')) END
  FROM paths p
  LEFT JOIN (SELECT * FROM levels UNION ALL SELECT * FROM tops) n
    ON n.tree = p.tree AND n.level = p.level + 1 AND n.spot = p.spot // 3
  LEFT JOIN subroots s ON s.below = p.tree
  WHERE n.tree IS NOT NULL OR p.tree <> 'top'),
roots AS (SELECT digest AS root, level AS height FROM tops WHERE held = 1)
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(told) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM paths p JOIN subroots s ON s.below = p.below, roots
WHERE p.tree = 'top' AND p.level = height"""

ORACLE: dict[str, str] = {
    "op1_merkle_audit": _AUDIT,
    "op6_license_scan": _LICENSES,
    "op10_source_mixing": _MIXING,
    "op11_dataset_manifest": _MANIFEST,
}
