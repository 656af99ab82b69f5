"""Corpus pipeline: every stage works on all that the one before it kept.

Each stage takes (session, documents, folder of tables) and returns a table;
`run` stores it as Parquet in the shared folder and gives it to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settle.llm import bpe, decontaminate, language_id, secrets, simhash
from settle.llm.common import prepare, store, table
from settle.llm.queries import multilingual, token_digests


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go."""
    prepare(spark)
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepare(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold passages of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, live-looking secrets masked."""
    prepare(spark)
    masked = secrets.mask_live(docs)
    return masked.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), "n_chars"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left, with digests of ids and decoded bytes."""
    prepare(spark)
    vocabulary = multilingual()
    return token_digests(bpe.round_trip(docs, vocabulary, ["doc_id"]), vocabulary)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("byte_bpe", tokenize),
]

# Language models and near-duplicate fingerprints are beyond SQL; the operators of
# the stages have tests of their own, those of the pipeline check columns and counts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
