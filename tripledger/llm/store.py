"""Tables written to the shared folder, which cut lineage and survive lost executors."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.session import scratch_dir

# A key is hot when it holds at least one in HOT_SHARE of all rows; there are at most that many.
HOT_SHARE = 1000


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once below the shared folder and read back."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a job, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def join_counted(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int,
                 how: str = "left") -> DataFrame:
    """Join ``groups``, one row for each key with its number of rows ``size``, to ``rows``.

    Rows of hot keys meet a broadcast list of at most HOT_SHARE groups and are never dealt out by
    their key; only the others go through a shuffled join. ``rows`` is read twice, and its key must
    not be null.
    """
    hot = groups.where(F.col(size) * HOT_SHARE >= total)
    cold = groups.where(F.col(size) * HOT_SHARE < total)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return rows.join(F.broadcast(hot), key).unionByName(rest)
