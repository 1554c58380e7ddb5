"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet under the shared checkpoint folder and reads it back as
the next stage's documents. All stages but the last return the columns of the
documents. An empty table passes through every stage; rows with null or empty
texts are ordinary documents that agree with each other, so one of them stays.
"""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import grace, kn_toxicity, packing, pii, probminhash
from clickloom.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models call toxic go. The models
    learn from the labelled rows among ``docs``, held-out ones left out."""
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    return kn_toxicity.keep_ordinary(docs, kn_toxicity.fit(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the largest doc_id, stays."""
    return grace.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates, the least doc_id, stays."""
    return probminhash.keep_one(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to placeholders; every row stays."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as token ids, in pieces of training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pii", redact_pii),
    ("packing", pack),
]

#: trained models and near-duplicate classes have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    job = uuid.uuid4().hex
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{job}/{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
