"""A corpus made ready for training: each stage works on all that the one before kept.

All stages but the last return the columns of documents; the last returns token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import byte_bpe, exact_dedup, jaccard_join, langid, mixing
from feedloom.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language a network learnt from the labelled ones can tell."""
    return langid.accepted(docs, langid.learn(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, the one with the largest doc_id."""
    return exact_dedup.survivors(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-equal shingles, the one with the smallest doc_id."""
    return jaccard_join.survivors(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources has them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, what they decode to as a digest, and its offsets' summary."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"), "n_split",
    )


STAGES = [
    ("language", language), ("exact_dedup", exact), ("jaccard_join", near), ("mixing", mixture),
    ("byte_bpe", tokens),
]

#: Training, dependent rounding and byte pairs are beyond SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
