"""The registered queries: each operator on its whole table.

Operators have interfaces of their own; a query names the table, keeps the
production parameters and derives the columns it reports.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywork.llm import (
    alignment,
    boosting,
    bpe,
    credentials,
    decontamination,
    licenses,
    manifest,
    merkle,
    mixing,
    resampling,
    simhash,
    toxicity,
    wrappers,
)
from tallywork.llm.common import written

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Pages per archive file.
FILE_PAGES = 256


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as records of archive files: ``file``, ``offset``, ``digest``, ``worn``, ``lost``.

    A file holds the pages of a range of ids one after the other, in order of
    id. Pages without an id form files by the hash of their address.

    The table has no second replica, so one is derived with damage that
    depends on the page alone: pages whose length is a multiple of 41 have
    their last byte changed (``worn`` is the digest in the replica), those one
    longer are ``lost``.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    file = F.coalesce(F.floor(F.col("page_id") / FILE_PAGES), -F.pmod(F.xxhash64("url", "html"), F.lit(1 << 40)) - 1)
    data = merkle.warc_record(F.col("url"), F.col("page_id"), F.col("html"))
    rest = F.coalesce(F.length("html"), F.lit(0)) % 41
    rows = pages.select("page_id", file.cast("bigint").alias("file"), data.alias("data"), rest.alias("rest"))
    length = F.octet_length("data")
    flipped = F.concat(F.substring("data", 1, length - 1), F.lit("!").cast("binary"))
    digest = merkle.record_digest(F.col("data"))
    rows = rows.select(
        "page_id", "file", length.alias("length"), digest.alias("digest"),
        F.when(F.col("rest") == 0, merkle.record_digest(flipped)).otherwise(digest).alias("worn"),
        (F.col("rest") == 1).alias("lost"),
    )
    before = Window.partitionBy("file").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint")
    return written(rows.withColumn("offset", offset), "archives")


def op1_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archives(spark, sf_dir)
    replica = records.where(~F.col("lost"))
    return merkle.audit(merkle.hash_tree(records), merkle.hash_tree(replica, digest="worn"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = boosting.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *base, "base_failed", "kept", "score")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "lcs", "answer", "near_word")


def op4_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.scan(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file is; executors have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering takes the line feeds out of texts whose id has an even crc32."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    fields = [F.coalesce(tampered, F.col("text")) if f == "text" else F.col(f) for f in MANIFEST_FIELDS]
    docs = table(spark, sf_dir, "documents")
    found = manifest.manifest(docs, MANIFEST_FIELDS, also={"tampered": manifest.leaf(fields)})
    found = found.withColumn("folded_root", manifest.folded(F.col("tampered"), F.col("segments")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", manifest.digest(manifest.proof_text(F.col("segments"))).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    aligned = alignment.align(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))
    sha = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    found = alignment.scored(aligned.withColumn("groups_sha256", sha).drop("groups"))
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    told = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(told.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_merkle_audit": op1_merkle_audit,
    "op2_quality_rules": op2_quality_rules,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_wrapper_extraction": op4_wrapper_extraction,
    "op5_importance_resampling": op5_importance_resampling,
    "op6_license_scan": op6_license_scan,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_toxicity": op9_toxicity,
    "op10_source_mixing": op10_source_mixing,
    "op11_dataset_manifest": op11_dataset_manifest,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_bpe_codec": op13_bpe_codec,
}
