"""Corpus pipeline: quality rules, near-duplicates, decontamination, secrets, BPE.

``STAGES`` are applied in order; each function takes (spark, docs, sf_dir), and
its result is written as Parquet and reread as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import bpe_codec, decontamination, quality_rules, secret_scan, simhash_dedup
from tickwise.llm.common import cut, table
from tickwise.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are masked in the texts."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return bpe_codec.round_trip(docs, bpe_codec.ByteBpe.load(tokenizer_path("byte_bpe_50k.json")))


STAGES = [
    ("quality_rules", quality),
    ("simhash_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", secrets),
    ("bpe_codec", bpe),
]

#: Not expressible as a whole: SQL has no XXH64 and no merge loop; stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
