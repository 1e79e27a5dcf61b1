"""The registered queries of the corpus operators: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe_codec,
    collocations,
    decontamination,
    html_text,
    language_id,
    quality_rules,
    secret_scan,
    simhash_dedup,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from .common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = token_counts.PieceVocab.load(tokenizer_path("piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocab)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    bpe = bpe_codec.ByteBpe.load(tokenizer_path("byte_bpe_50k.json"))
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), bpe)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language_id.held_out()
    langs, p = language_id.train(docs.where(~out))
    return language_id.predict(docs.select("doc_id", out.alias("held_out"), "text"), langs, p,
                               extra=("held_out",))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated_pairs(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.held_out()
    model = toxicity.train(docs.where(~out), table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", out.alias("held_out"), "text"), model, extra=("held_out",))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_simhash_dedup, op3_secret_scan, op4_quality_rules, op5_html_extraction,
    op6_bpe_codec, op7_warc, op8_language_id, op9_suffix_dedup, op10_decontamination,
    op11_toxicity, op12_embedding_whitening, op13_phrase_collocations)}
