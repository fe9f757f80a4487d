"""A training-data pipeline over the documents table.

Documents that fail the quality rules go; of equal texts the one with the largest identifier stays;
of near duplicates the one with the smallest identifier stays; the sources are mixed to their target
shares by replication; the texts are encoded into pieces. Each stage's rows are written to the
shared folder and read again, so a lost executor repeats no earlier stage.

Defined results: an empty table gives an empty result with the same columns; a null or empty text
fails the quality rules; texts of any length are read whole; of repeated rows one is left, and copies of
it that mixing makes; different texts under one key, or without one, are rows of their own in every
stage; of equal texts with equal keys any one stays, as they don't differ in what decides; further
columns of the documents, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm.exact_dedup import keep_one
from tripledger.llm.mixing import mixed_rows
from tripledger.llm.near_dedup import keep_first
from tripledger.llm.pieces import encode
from tripledger.llm.repetition import keep_clean
from tripledger.llm.sources import small_batches, table, tokenizer
from tripledger.llm.store import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return keep_clean(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return keep_first(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens): the pieces of each row with an end id."""
    small_batches(spark)
    found = encode(docs.select("doc_id", "text"), tokenizer("piece_bpe_32k.model"), spans=False)
    return found.select(F.col("id").alias("doc_id"), "ids",
                        F.size("ids").cast("bigint").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]

# MinHash signatures and piece merges have no statement in SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
