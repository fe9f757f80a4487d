"""Checks that return the offending rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.operators.rules import REJECTING


def expect_not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def expect_unique(rows: DataFrame, column: str) -> DataFrame:
    """Repeated values with their count; the partial count keeps a frequent value small."""
    return (rows.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count("*").alias("occurrences")).where("occurrences > 1"))


def expect_accepted(rows: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    return rows.where(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))


REJECTING_RULE_IDS = tuple(r.rule_id for r in REJECTING)
DIMENSIONS = ("pickup_area", "dropoff_area", "route")


def offences(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check with the number of offending rows."""
    counted = [rows.agg(F.lit(name).alias("check"), F.count("*").alias("offending_rows"))
               for name, rows in checks.items()]
    return reduce(DataFrame.unionByName, counted)


def assert_duration_positive(valid: DataFrame) -> DataFrame:
    bad = F.col("trip_duration").isNull() | (F.col("trip_duration") <= 0)
    return valid.where(bad).select("id", "trip_duration")


def assert_non_negative(valid: DataFrame) -> DataFrame:
    columns = ("estimated_distance_km", "estimated_speed_kmh")
    return valid.where((F.col(columns[0]) < 0) | (F.col(columns[1]) < 0)).select("id", *columns)


def assert_has_reason(quarantine: DataFrame) -> DataFrame:
    named = ("rule_id", "quarantine_reason")
    return (quarantine.where(F.col(named[0]).isNull() | F.col(named[1]).isNull())
            .select("id", *named))


def assert_reconciliation(quality: DataFrame) -> DataFrame:
    return quality.where(~F.col("reconciles")).select(
        "source_hash", "total_records", "valid_records", "quarantined_records")


def assert_share_100(vendors: DataFrame, tolerance: float = 0.01) -> DataFrame:
    total = F.round(F.sum("kpi_013_vendor_trip_share_pct"), 4).alias("total_share")
    return vendors.agg(total).where(F.abs(F.col("total_share") - 100.0) > tolerance)


def assert_outliers_kept(trips: DataFrame, valid: DataFrame, limit: int) -> DataFrame:
    """Extreme durations among trips that pass, counted before and after the split."""
    before = trips.where(F.col("is_valid_trip")).agg(
        F.count_if(F.col("trip_duration") > limit).alias("n"))
    after = valid.agg(F.count_if(F.col("is_duration_outlier")).alias("n"))
    return valid.sparkSession.range(1).select(before.scalar().alias("extreme_before"),
                                              after.scalar().alias("extreme_kept"))


def audit_overlap(valid: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Ids in both tables. Rejected ids are made distinct first, so a hot one joins once."""
    rejected = quarantine.where(F.col("id").isNotNull()).select("id").distinct()
    return valid.select("id").join(rejected, "id", "left_semi")


def compare(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of the first frame, and how many rows either has more often than the other.

    Each frame is computed once: equal rows meet in one grouping and cancel out.
    """
    sides = (first.withColumn("side", F.lit(1)).unionByName(second.withColumn("side", F.lit(-1))))
    balance = sides.groupBy(*first.columns).agg(
        F.sum("side").alias("surplus"), F.count_if(F.col("side") == 1).alias("n"))
    return balance.agg(F.sum("n").alias("rows"),
                       F.sum(F.abs("surplus")).alias("differing_rows"))
