"""Secret scans that link the parts of a credential.

Strong parts (assignments, access identifiers, long hex runs) are reported
wherever they stand. Weak parts (bare identifiers, bare high-variety strings,
endpoints) are harmless alone and are reported only when a part of another
role stands in the same scope: a secret with an identifier or an endpoint.

Parts become rows, one interval each, and meet in an interval join: within a
text, the nearest interval of each role on either side is found in one pass in
order of starts and one in order of ends. A text full of parts costs its
number of parts, where pairs would cost the square.

A pattern's matches and the pieces between them have lengths, and their
running sum gives the place of every match, so no text is shuffled.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.common import null_safe_join, row_key, text_or_empty

# What the base rules look for. The patterns of access and hex
# only spell out the least length, which picks the same runs.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE_LENGTH = 6

_EDGE = r"A-Za-z0-9+/_=-"
WEAK_ID = rf"(?<![{_EDGE}])(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{{16,}}+(?![{_EDGE}])"
# Runs of key characters, each looked at once; what a run must hold is asked of
# the run alone, so that a text without blanks takes time in proportion.
WEAK_SECRET = rf"(?<![{_EDGE}])[A-Za-z0-9+/_-]{{32,}}+={{0,2}}(?![{_EDGE}])"
WEAK_SECRET_HOLDS = ("[a-z]", "[A-Z]", "[0-9]")
ENDPOINT = r"(?:https?|s3|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~-]+(?::[0-9]+)?"

#: name, pattern, role, strong; in the order that breaks ties of place.
KINDS = (
    ("assign", ASSIGN, "secret", True),
    ("access", ACCESS, "id", True),
    ("hex", HEX, "secret", True),
    ("id", WEAK_ID, "id", False),
    ("key", WEAK_SECRET, "secret", False),
    ("endpoint", ENDPOINT, "endpoint", False),
)
ROLES = ("id", "secret", "endpoint")
#: Code points between two parts of one credential, at most.
SCOPE = 200
KEY = ["key_id", "key_text"]


def _of(kinds: list[int]) -> Column:
    return F.col("kind").isin(kinds)


def _matches(number: int, pattern: str) -> Column:
    """Each match of one kind in ``whole`` with the length of the piece before it."""
    found = F.regexp_extract_all("whole", F.lit(pattern), F.lit(0))
    skipped = F.transform(F.split("whole", pattern, -1), F.length)
    zipped = F.arrays_zip(skipped.alias("skipped"), found.alias("found"))
    return F.transform(zipped, lambda z, place: F.struct(
        F.lit(number).alias("kind"), place.alias("place"),
        z["skipped"].alias("skipped"), z["found"].alias("found"),
    ))


def may_hold(text: Column) -> Column:
    """False for texts of which nothing is reported: they have neither a strong part nor a bare secret."""
    some = [text_or_empty(text).rlike(p) for name, p, _, strong in KINDS if strong or name == "key"]
    return reduce(or_, some)


def _parts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per match: the row's key, ``kind``, ``start``, ``end`` in code points."""
    rows = docs.where(may_hold(F.col(text)))
    rows = rows.select(*row_key(doc_id, text), text_or_empty(F.col(text)).alias("whole"))
    listed = [_matches(number, kind[1]) for number, kind in enumerate(KINDS)]
    rows = rows.select(*KEY, F.explode(F.concat(*listed)).alias("part")).select(*KEY, "part.*")
    rows = rows.where(F.col("found").isNotNull())
    value = F.length(F.regexp_extract("found", ASSIGN, 1))
    varied = reduce(and_, [F.col("found").rlike(c) for c in WEAK_SECRET_HOLDS])
    names = [k[0] for k in KINDS]
    holds = F.when(_of([names.index("assign")]), value >= ASSIGN_VALUE_LENGTH)
    holds = holds.when(_of([names.index("key")]), varied).otherwise(True)
    rows = rows.select(*KEY, "kind", "place", "skipped", F.length("found").alias("length"), holds.alias("holds"))
    # Copies of a row count once.
    rows = rows.dropDuplicates([*KEY, "kind", "place"])
    so_far = Window.partitionBy(*KEY, "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("skipped") + F.col("length")).over(so_far)
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    return placed.where("holds").select(*KEY, "kind", "start", "end")


def credential_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per reported span: the row's key, ``kind`` (a number into ``KINDS``), ``start``, ``end``.

    A weak part inside a strong one is part of that one and not reported.
    """
    parts = _parts(docs, doc_id, text)
    by_text = Window.partitionBy(*KEY)
    ahead = by_text.orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = by_text.orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    strong = [n for n, k in enumerate(KINDS) if k[3]]
    near = {"strong": _of(strong)} | {r: _of([n for n, k in enumerate(KINDS) if k[2] == r]) for r in ROLES}
    columns = {f"{r}_end": F.max(F.when(c, F.col("end"))).over(ahead) for r, c in near.items()}
    columns |= {f"{r}_start": F.min(F.when(c, F.col("start"))).over(behind) for r, c in near.items()}
    seen = parts.withColumns(columns)
    inside = F.coalesce(F.col("strong_end") > F.col("start"), F.lit(False)) | F.coalesce(
        F.col("strong_start") < F.col("end"), F.lit(False)
    )

    def meets(role: str) -> Column:
        left = F.coalesce(F.col("start") - F.col(f"{role}_end") <= SCOPE, F.lit(False))
        return left | F.coalesce(F.col(f"{role}_start") - F.col("end") <= SCOPE, F.lit(False))

    linked = F.when(near["secret"], meets("id") | meets("endpoint")).otherwise(meets("secret"))
    return seen.where(near["strong"] | (~inside & linked)).select(*KEY, "kind", "start", "end")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``.

    ``spans`` lists all spans as kind:start:end by start, then by kind in the
    order of ``KINDS``; ``base_sha256`` is the digest of that list with strong
    kinds only.

    Null and empty texts have no spans: counts 0, an empty list and its
    digest. Null ids are kept. Copies of a row, and rows of one id with
    different texts, each get their own result. No rows give no rows. Other
    columns are not looked at. The spans of one text are gathered in one row.
    """
    found = credential_spans(docs, doc_id, text)
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    shown = F.concat_ws(":", F.get(names, F.col("kind")), "start", "end")
    found = found.withColumn("part", F.struct("start", "kind", "end", shown.alias("shown")))
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda p: p["shown"]), ",")
    strong = _of([n for n, k in enumerate(KINDS) if k[3]])
    summed = found.groupBy(*KEY).agg(
        *[F.count_if(F.col("kind") == n).alias(f"n_{k[0]}") for n, k in enumerate(KINDS) if k[3]],
        listed(F.when(strong, F.col("part"))).alias("base"),
        listed("part").alias("spans"),
    )
    joined = null_safe_join(docs.select(*row_key(doc_id, text)), summed, KEY, "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return joined.select(
        F.col("key_id").alias("doc_id"), count("n_assign"), count("n_access"), count("n_hex"),
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redacted(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mark: str = "[secret]", length: str | None = None
) -> DataFrame:
    """The columns of ``docs`` with every reported span replaced by ``mark``.

    Spans that overlap are replaced by one mark. If ``length`` names a column,
    it gets the code points of the new text. Texts without spans stay as they
    are, null and empty ones included, and null ids are kept. Copies of a row,
    and rows of one id with different texts, are each redacted by their own
    spans; the other columns stay with their row, whatever their names. No rows
    give no rows. Only texts that may hold a span are shuffled.
    """
    bare = docs.where(~may_hold(F.col(text)))
    docs = docs.where(may_hold(F.col(text)))
    found = credential_spans(docs, doc_id, text)
    # Overlapping spans become one.
    ahead = Window.partitionBy(*KEY).orderBy("start", "end")
    reach = F.max("end").over(ahead.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("opens", F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1)))
    found = found.withColumn("span", F.sum("opens").over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    found = found.groupBy(*KEY, "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    # Each span with the end of the one before it, to copy what lies between.
    found = found.withColumn("after", F.coalesce(F.lag("end").over(Window.partitionBy(*KEY).orderBy("span")), F.lit(0)))
    summed = found.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("start", "after"))).alias("cuts"), F.max("end").alias("rest")
    )
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    rows = rows.select("row", F.col(f"row.{text}").alias("whole"), F.col(f"row.{doc_id}").alias("own_id"))
    rows = rows.select("row", "whole", *row_key("own_id", "whole"))
    joined = null_safe_join(rows, summed, KEY, "left")
    between = F.transform("cuts", lambda c: F.substr(
        F.col("whole"), (c["after"] + 1).cast("int"), (c["start"] - c["after"]).cast("int")))
    left = F.substr(F.col("whole"), (F.col("rest") + 1).cast("int"))
    clean = F.when(F.col("cuts").isNull(), F.col("whole")).otherwise(
        F.array_join(F.concat(between, F.array(left)), mark))
    joined = joined.select("row", "cuts", clean.alias("clean"))
    out = []
    for name in docs.columns:
        column = F.col(f"row.{name}")
        if name == text:
            column = F.col("clean")
        elif name == length:
            column = F.when(F.col("cuts").isNull(), column).otherwise(F.length("clean").cast("bigint"))
        out.append(column.alias(name))
    return bare.unionByName(joined.select(*out))
