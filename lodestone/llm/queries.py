"""The registered queries: one thin opN_<name> for each operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, fingerprint, langid, line_dedup, ngram_join, pii, quality, suffix_dedup
from .oracles import ORACLE  # noqa: F401

#: The vocabulary file of op6, a parameter.
BPE_FILE = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(quality.held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.dedup(table(spark, sf_dir, "documents")))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


def op9_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.reply_ordered(table(spark, sf_dir, "conversations"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.learn(langid.training_rows(docs)))
    return found.select("doc_id", F.coalesce(langid.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_ngram_join": op2_ngram_join,
    "op3_fingerprints": op3_fingerprints,
    "op4_quality": op4_quality,
    "op5_decontamination": op5_decontamination,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_pii": op8_pii,
    "op9_quotation_linking": op9_quotation_linking,
    "op10_language_id": op10_language_id,
}
