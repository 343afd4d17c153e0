"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import (
    centroids,
    filter_audit,
    lm,
    minhash,
    pii,
    prefix_counts,
    quality,
    records,
    secrets,
    sharding,
    templates,
    transducer,
    voronoi,
)
from citeloom.llm.oracles import ORACLES
from citeloom.llm.session import documents
from citeloom.scratch import Scratch


def op1_minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(documents(spark, sf_dir), Scratch(spark, "minhash"))


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        Scratch(spark, "token-records"),
        end_id=2,
        vocabulary_size=50_257,
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.round_trip(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(documents(spark, sf_dir), Scratch(spark, "lm"))


def op5_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), ["doc_id"], Scratch(spark, "quality"))


def op6_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op7_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return templates.contaminated(documents(spark, sf_dir), benchmark)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(documents(spark, sf_dir), Scratch(spark, "secrets"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = prefix_counts.prefix_counts(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op10_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.minimax_shards(documents(spark, sf_dir), 8, Scratch(spark, "shards"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return centroids.cluster(vectors, Scratch(spark, "centroids"))


def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return voronoi.top_products(vectors, Scratch(spark, "voronoi"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.audit(documents(spark, sf_dir), labels, Scratch(spark, "audit"))


QUERIES = {
    "op1_minhash_classes": op1_minhash_classes,
    "op2_token_records": op2_token_records,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_lm_scores": op4_lm_scores,
    "op5_quality_outliers": op5_quality_outliers,
    "op6_pii_spans": op6_pii_spans,
    "op7_template_decontamination": op7_template_decontamination,
    "op8_secret_scan": op8_secret_scan,
    "op9_token_counts": op9_token_counts,
    "op10_minimax_shards": op10_minimax_shards,
    "op11_centroids": op11_centroids,
    "op12_top_products": op12_top_products,
    "op13_filter_audit": op13_filter_audit,
}
__all__ = ["ORACLES", "QUERIES"]
