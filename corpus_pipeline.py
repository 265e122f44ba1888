"""A corpus pipeline of five stages over documents, each by one operator of lodestone.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run()
writes to the shared folder and reads again as the next one's docs. All but the
last return the columns of documents; where a stage changes a text, n_chars
follows it. Rows are told apart by id and text: rows that share only an id, and
rows with a null id, are documents of their own, and of rows that are equal in both
the near-duplicate stage keeps one. Null and empty texts go in the first stage;
empty tables pass through, very long texts are treated whole, and columns that
documents does not have are left out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, decontam, langid, line_dedup, ngram_join
from lodestone.llm.common import dropped, written
from lodestone.llm.queries import BPE_FILE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The near-duplicate stage's shingles and similarity (in hundredths).
SHINGLE, PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any text in a language (null, empty, no letter) go."""
    docs = docs.select(COLUMNS)
    found = langid.identify(docs, langid.learn(langid.training_rows(docs)))
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier one go, and with them documents that have no other line."""
    found = line_dedup.dedup(docs.select(COLUMNS))
    changed = F.col("n_removed") > 0
    found = found.where(~changed | (F.col("n_removed") < F.col("n_lines")) & F.col("text").rlike(r"\S"))
    return found.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def join_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the least id stays (nulls last)."""
    docs = docs.select(COLUMNS).withColumn("key", row_key())
    found = ngram_join.link(docs.select(F.col("key").alias("doc_id"), "text"), SHINGLE, PERCENT)
    classes = docs.select("key", "doc_id").join(found.select(F.col("doc_id").alias("key"), "component_id").distinct(), "key")
    least = classes.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "key"))["key"].alias("key"))
    return docs.join(least.select("key"), "key").dropDuplicates(["key"]).select(COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an exact occurrence of a benchmark window go."""
    docs = docs.select(COLUMNS).withColumn("key", row_key())
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.decontaminate(docs.select(F.col("key").alias("doc_id"), "text"), items)
    hit = found.where(F.size("hit_spans") > 0).select(F.col("doc_id").alias("key")).distinct()
    return docs.join(hit, "key", "left_anti").select(COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left."""
    return bpe.round_trip(docs, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("ngram_join", join_near),
    ("decontamination", drop_leaks),
    ("byte_bpe", tokenize),
]

#: Suffix automata and byte pairs are not for SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        dropped(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
