"""Registered queries of this package: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import bpe, decontamination, divergence, embedding_dedup, hard_negatives, mixing, sharding, simhash, suffix_dedup, token_counts, topk, toxicity, warc

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.by_first_position(mixing.plan_mix(table(spark, sf_dir, "documents")))
    return plan.select(
        "doc_id", "size", "source_size", "target", "taken", "full_passes", "first_position"
    )


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = mixing.training_order(mixing.plan_mix(table(spark, sf_dir, "documents")))
    return reads.select("doc_id", "source", "pass", "words", "position")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), RANKS)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.load_codec(RANKS, public_tokenizers.PATTERN)
    return bpe.round_trip(table(spark, sf_dir, "documents"), codec)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine_hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.find_overlaps(docs, items, columns=("doc_id",))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The stages are a file of their own at the top of the repository.
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_mixing": op2_mixing,
    "op2_training_order": op2_training_order,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_sharding": op4_sharding,
    "op5_simhash": op5_simhash,
    "op6_warc": op6_warc,
    "op7_toxicity": op7_toxicity,
    "op8_topk": op8_topk,
    "op9_token_counts": op9_token_counts,
    "op10_bpe": op10_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_decontamination": op12_decontamination,
    "op13_divergence": op13_divergence,
    "pipeline": pipeline,
}
