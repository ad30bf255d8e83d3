import hashlib
import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tallywork.llm import manifest, queries
from tests.llm import tables

FIELDS = queries.MANIFEST_FIELDS


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row
    return sha("".join(map(told, (doc_id, source, lang, n_chars, text))))


def climb(digests):
    """Root of a list of digests, and the siblings of each, level by level, as left and right."""
    proofs, places = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for n, at in enumerate(places):
            run = digests[at // 3 * 3 : at // 3 * 3 + 3]
            proofs[n].append((run[: at % 3], run[at % 3 + 1 :]))
            places[n] = at // 3
        digests = [sha("".join(digests[i : i + 3])) for i in range(0, len(digests), 3)]
    return digests[0], proofs


def plain(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    groups = {}
    for source in order:
        ranked = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        groups[source] = ranked, *climb([leaf_of(r) for r in ranked])
    root, above = climb([groups[s][1] for s in order])
    out = []
    for source, higher in zip(order, above):
        ranked, subroot, proofs = groups[source]
        for row, proof in zip(ranked, proofs):
            path = proof + higher
            changed = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None:
                changed[1] = row[1].replace("\n", "")
            folded = leaf_of(changed)
            for left, right in path:
                folded = sha("".join([*left, folded, *right]))
            told_proof = "".join("".join(left + right) for left, right in path)
            out.append((row[0], leaf_of(row), subroot, root, sha(told_proof), folded, folded == root))
    return out


def some_rows(seed, n, sources):
    rng = random.Random(seed)
    rows = [tables.row(i, tables.prose(rng, rng.randint(1, 9)).replace(" ", rng.choice(" \n"), 1), rng.choice(sources)) for i in range(n)]
    return rows + rows[: n // 10]


def write(spark, path, rows):
    tables.clashing(tables.documents(spark, rows)).repartition(5).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_query_equals_a_plain_model(spark, tmp_path):
    cases = {
        "odd": tables.ODD, "one": tables.ODD[4:5], "single source": some_rows(1, 40, "a"),
        "hot source": some_rows(2, 200, "aaaaaaaab") + tables.ODD, "many sources": some_rows(3, 120, [f"s{i}" for i in range(50)] + ["é", "S", ""]),
    }
    for name, rows in cases.items():
        got = queries.op11_dataset_manifest(spark, write(spark, tmp_path / name.replace(" ", "_"), rows))
        assert tables.values(got) == Counter(plain(rows)), name


def test_empty_table(spark):
    docs = tables.documents(spark, tables.ODD[:1]).limit(0)
    assert manifest.manifest(docs, FIELDS).isEmpty()


def test_rows_are_ranked_within_hot_groups(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("g"), (F.col("id") * 7919 % 3000).alias("k")
    ).repartition(9)
    got = manifest.ranked(rows, "g", ["k"]).collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r.g, []).append((r.at, r.k, r.held))
    for found in by_group.values():
        assert [a for a, _, _ in sorted(found)] == list(range(len(found)))
        assert [k for _, k, _ in sorted(found)] == sorted(k for _, k, _ in found)
        assert {h for _, _, h in found} == {len(found)}


def test_proofs_without_broadcasts(spark, monkeypatch):
    rows = some_rows(5, 150, "aab")
    docs = tables.documents(spark, rows)
    wanted = {(r[0], r[1], r[3]) for r in plain(rows)}
    monkeypatch.setattr(manifest, "BROADCAST_BYTES", 0)
    found = manifest.manifest(docs, FIELDS)
    whole = found.withColumn("folded", manifest.folded(F.col("leaf"), F.col("segments"))).collect()
    assert {(r.doc_id, r.leaf, r.root) for r in whole} == wanted and all(r.folded == r.root for r in whole)


def test_manifest_runs_no_python(spark):
    plan = manifest.manifest(tables.documents(spark, tables.ODD), FIELDS)._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
