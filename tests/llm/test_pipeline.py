import random

import corpus_pipeline
from pyspark.sql import functions as F

from tallywork.llm import credentials, decontamination, mixing, resampling, simhash
from tests.llm import tables
from tests.llm.test_boosting import junk


def corpus():
    rng = random.Random(21)
    rows = [tables.row(i, tables.prose(rng, rng.randint(60, 200)), rng.choice("ab")) for i in range(80)]
    rows += [tables.row(200 + i, rows[i][1], "b") for i in range(10)]
    rows += [tables.row(300 + i, junk(rng, 80), "a") for i in range(10)]
    item = " ".join("q" + a + b for a, b in zip(tables.prose(rng, 30).lower().split(), tables.prose(rng, 30).lower().split()))
    rows += [tables.row(400 + i, f"{tables.prose(rng, 40)} {item} {tables.prose(rng, 40)}", "a") for i in range(5)]
    rows += [tables.row(500 + i, f"{tables.prose(rng, 70)} token = \"{'%040x' % rng.getrandbits(160)}\"", "b") for i in range(5)]
    return rows, [(1, item)]


def write(spark, path, rows, items):
    labels = [(r[0], int(not 300 <= r[0] < 400), 0) for r in rows if r[0] is not None]
    tables.documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, tables.LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, tables.BENCHMARK).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_in_order_and_their_decisions(spark, tmp_path):
    rows, items = corpus()
    sf_dir = write(spark, tmp_path, rows, items)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        kept = tmp_path / name
        out.write.parquet(str(kept))
        docs = spark.read.parquet(str(kept))
        ids.append({r.doc_id for r in docs.collect()})
    sampled, single, clean, hidden, mixed = ids
    first = {r[0] for r in rows}
    assert first - sampled == set(range(300, 310))
    assert sampled - single == set(range(200, 210))
    assert single - clean == set(range(400, 405))
    assert hidden == clean
    assert mixed <= clean and docs.where("copies < 1").isEmpty()
    texts = spark.read.parquet(str(tmp_path / "secret_scan")).where("doc_id >= 500").collect()
    assert all(r.text.endswith("[secret]\"") and r.n_chars == len(r.text) for r in texts) and len(texts) == 5
    run = corpus_pipeline.run(spark, sf_dir)
    assert tables.values(run) == tables.values(docs)


def test_stages_equal_their_operators(spark, tmp_path):
    rows, items = corpus()
    sf_dir = write(spark, tmp_path, rows, items)
    docs, labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    kept = {r.doc_id for r in resampling.resample(docs, labels).where("kept").collect()}
    docs = docs.where(docs["doc_id"].isin(sorted(kept)))
    least = {r.doc_id for r in simhash.near_duplicates(docs).where("doc_id = component_id").collect()}
    docs = docs.where(docs["doc_id"].isin(sorted(least)))
    leaking = {r.doc_id for r in decontamination.contaminated(docs, benchmark).collect()}
    docs = credentials.redacted(docs.where(~docs["doc_id"].isin(sorted(leaking))), length="n_chars")
    taken = {(r.doc_id, r.copies) for r in mixing.mix(docs).where("copies > 0").collect()}
    assert {(r.doc_id, r.copies) for r in corpus_pipeline.run(spark, sf_dir).collect()} == taken


def test_odd_and_empty_tables(spark, tmp_path):
    odd = write(spark, tmp_path / "odd", tables.ODD, [(1, None)])
    kept = {r.doc_id for r in corpus_pipeline.run(spark, odd).collect()}
    assert {4, 5, 6, None} <= kept <= {1, 4, 5, 6, 7, None}
    empty = write(spark, tmp_path / "empty", tables.ODD[:1], [(1, None)])
    spark.read.parquet(f"{empty}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/empty2/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{empty}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/empty2/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty2").isEmpty()


def test_the_leak_stage_fits_its_space_on_all_passages(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    rows = [tables.row(i, tables.prose(rng, rng.randint(480, 620))) for i in range(640)]
    rows += [tables.row(1, None), tables.row(None, "one more"), tables.row(2, ""), rows[0]]
    sf_dir = write(spark, tmp_path, rows, [(1, tables.prose(rng, 40))])
    fitted, sizes = decontamination._fitted, []

    def counted(coded):
        sizes.append({k: n for k, n in coded.groupBy("kind").agg(F.sum(F.octet_length("words"))).collect()})
        return fitted(coded)

    monkeypatch.setattr(decontamination, "_fitted", counted)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert corpus_pipeline.drop_leaks(spark, docs, sf_dir).count() == len(rows)
    blocks = sum(-(-len((r[1] or "").split()) // decontamination.BLOCK_WORDS) for r in rows)
    # More than the 20,000 passages that once were drawn.
    assert blocks > 20_000
    assert sizes == [{"corpus": 32 * blocks, "benchmark": 32 * 3}]
