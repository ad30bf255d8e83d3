import random
import re

import xxhash

from tallywork.llm import simhash
from tallywork.llm.components import connected
from tests.llm import tables

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(points, radius):
    root = {p: p for p in points}
    changed = True
    while changed:
        changed = False
        for a in points:
            for b in points:
                if (a ^ b).bit_count() <= radius and root[b] < root[a]:
                    root[a], changed = root[b], True
    return root


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprint_equals_a_plain_model():
    rng = random.Random(3)
    texts = [None, "", " \n\t", "A", "Ab cD", "ÄÖ É x y z", "a " * 70_000, "\x0b\x0cq\x85w e\xa0r t"]
    texts += [tables.prose(rng, n) for n in (3, 4, 5, 50, 400)]
    for text in texts:
        assert simhash.fingerprint_of(text) == signed(plain_fingerprint(text)), repr(text)[:60]


def clustered(rng):
    points = {0, (1 << 64) - 1}
    for _ in range(12):
        seed = rng.getrandbits(64)
        for _ in range(14):
            point = seed
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                point ^= 1 << bit
            points.add(point)
    return sorted(points | {rng.getrandbits(64) for _ in range(150)})


def test_links_connect_what_brute_force_connects(spark):
    points = clustered(random.Random(8))
    fps = spark.createDataFrame([(signed(p),) for p in points], "fp bigint")
    links = simhash.fingerprint_links(fps)
    for a, b in links.collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 64
    found = {r.node: r.root for r in connected(links).collect()}
    parts, expected = {}, {}
    for p, r in plain_components(points, 4).items():
        expected.setdefault(r, set()).add(signed(p))
    for p in points:
        parts.setdefault(found.get(signed(p), signed(p)), set()).add(signed(p))
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, expected.values()))


def test_more_groups_find_the_same_links(spark, monkeypatch):
    fps = spark.createDataFrame([(signed(p),) for p in clustered(random.Random(9))], "fp bigint")
    few = tables.values(connected(simhash.fingerprint_links(fps)))
    monkeypatch.setattr(simhash, "BUCKET_VARIANTS", 1000)
    assert tables.values(connected(simhash.fingerprint_links(fps))) == few


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}


def test_rows_of_odd_tables(spark):
    docs = tables.clashing(tables.documents(spark, tables.ODD))
    found = simhash.near_duplicates(docs)
    assert found.count() == len(tables.ODD)
    blank = {r.doc_id: r.component_id for r in found.where("fp = 0").collect()}
    assert blank == {1: 1, 2: 1, 3: 1, None: 1}
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == [(False, 1), (False, 4), (False, 5), (False, 5), (False, 6), (False, 7), (True, 0)]
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).isEmpty() and simhash.one_per_group(empty).isEmpty()
