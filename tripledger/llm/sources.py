"""Where the queries' tables and vocabularies are."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def small_batches(spark: SparkSession) -> None:
    """Bound what reaches a task's Python at once: long texts make large batches of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Where a public vocabulary file is: below TOKENIZERS, or where its package has it."""
    if folder := os.environ.get("TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
