"""Frames written once below the shared folder, so that later steps share them and start from there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripledger.session import scratch_dir, shuffles_dropped


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once and read back with their real size known to the planner."""
    path = scratch_dir(rows.sparkSession, purpose)
    with shuffles_dropped(rows.sparkSession):
        rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Stages:
    """Stage tables by the fingerprint of their plan.

    A frame asked for again, by whatever part of a query, is the table written the first time: two
    frames are the same when Spark's canonical plans and their column names are. Keep one object for
    one query or build, as inputs are taken not to change meanwhile.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._held: dict[tuple, list[tuple[DataFrame, DataFrame]]] = {}

    def table(self, rows: DataFrame, purpose: str) -> DataFrame:
        held = self._held.setdefault((rows.semanticHash(), tuple(rows.columns)), [])
        for plan, kept in held:
            if plan.sameSemantics(rows):
                return kept
        kept = stored(rows, purpose)
        held.append((rows, kept))
        return kept
