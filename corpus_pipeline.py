"""From raw documents to token ids: each stage works on what the one before kept.

``STAGES`` holds ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again for the next. All but the last return the
columns of the documents they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import minhash, pii, quality, templates, transducer
from citeloom.scratch import Scratch


# Words and transitions remembered by a worker of the last stage. A worker keeps its tables while it
# waits, so they stand beside the heap that other stages need.
TABLES = (200_000, 200_000)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the outlier test rejects."""
    # The operator's own columns follow the document's, so they are told apart by place.
    given = docs.toDF(*[f"_doc_{i}" for i in range(len(docs.columns))])
    named = given.select(
        *given.columns,
        *[F.col(f"_doc_{docs.columns.index(c)}").alias(c) for c in ("text", "lang", "source")],
    )
    judged = quality.judge(named, given.columns, Scratch(spark, "quality"))
    return judged.where("kept").select(*given.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return minhash.keep_one(docs, Scratch(spark, "minhash")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    kept = templates.decontaminate(docs, benchmark, Scratch(spark, "templates"))
    return kept.select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.redact(docs).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with its text, token count and digests."""
    return transducer.round_trip(
        docs,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        keep=True,
        kept=TABLES,
    )


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("pii", personal_data),
    ("byte-level bpe", byte_bpe),
]
# Covariance estimates, sampling and tokenizing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
