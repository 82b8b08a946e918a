"""The registered queries of the corpus operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstguard.llm import bpe, centroids, divergence, licences, line_dedup, packing, pu, rules, sharding, simhash, suffix_dedup, topk, warc
from burstguard.llm.common import table


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the folder can be named in ``TOKENIZER_DIR``."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    body = F.coalesce("text", F.lit("")).cast("binary")
    keyed = docs.withColumn("whole_sha256", F.sha2(body, 256)).withColumns(suffix_dedup.text_keys())
    found = suffix_dedup.repeated_spans(docs).drop("kept_text")
    return (
        keyed.select("doc_id", "text_id", "n_bytes", "whole_sha256")
        .join(found, ["text_id", "n_bytes"], "left")
        .select(
            "doc_id",
            F.col("n_bytes").cast("long").alias("n_bytes"),
            F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce(F.size("spans") / 2, F.lit(0)).cast("long").alias("n_spans"),
            F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        )
    )


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "found.*")


def op3_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pu.train(docs, table(spark, sf_dir, "labels"))
    return pu.classify(docs, model).select("doc_id", "held_out", "score", "predicted")


def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return bpe.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.apply_policy(rules.ledger(table(spark, sf_dir, "documents")))
    base = F.lit(rules.POLICIES["base-1"]).cast("long")
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(base) != 0).alias("base_failed"),
        "kept",
        "fail_bits",
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleave(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"), k=40, rounds=5)[0]


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_licence_scan": op2_licence_scan,
    "op3_pu_quality": op3_pu_quality,
    "op4_bpe_roundtrip": op4_bpe_roundtrip,
    "op5_packing": op5_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_line_dedup": op7_line_dedup,
    "op8_sharding": op8_sharding,
    "op9_topk_search": op9_topk_search,
    "op10_simhash": op10_simhash,
    "op11_warc": op11_warc,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_centroids": op13_centroids,
}
