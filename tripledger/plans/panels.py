"""Datasets behind the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.functions.rounding import WIDE, pct, ratio, wide_sum
from tripledger.operators.histogram import (
    avg_duration, avg_km, avg_kmh, cell_percentiles, duration_cells,
)
from tripledger.sources.stages import stored


def _shown(value: Column, places: int, stored: int = 4, divisor: int = 1) -> Column:
    """A stored, already rounded number, divided and rounded again without a binary tie."""
    units = F.rint(value * F.lit(float(10**stored))).cast(WIDE)
    return ratio(units, F.lit(divisor * 10**stored), places)


def _minutes(seconds: str) -> Column:
    return _shown(F.col(seconds), 1, divisor=60)


def _one_value(row: DataFrame) -> Column:
    """A one-row frame as a scalar subquery that returns a struct."""
    return row.select(F.struct("*")).scalar()


def exec_tiles(valid: DataFrame, performance: DataFrame, demand: DataFrame,
               quality: DataFrame) -> DataFrame:
    """One row of headline numbers.

    Averages and percentiles are recomputed from trips; stored rates are weighted by trips,
    because a mean of group rates would give a quiet day the weight of a busy one. ``valid`` is the
    trips, or stored cells of them with a row for each group and duration.
    """
    trips = F.col("kpi_001_total_trips")

    def weighted(rate: str) -> Column:
        units = F.rint(F.col(rate) * 10000.0).cast("decimal(19,0)")
        return ratio(F.sum(units * trips.cast("decimal(19,0)")), wide_sum(trips) * 10000,
                     2).alias(rate)

    totals = performance.agg(F.sum(trips).alias("kpi_001_total_trips"),
                             weighted("kpi_016_long_trip_rate_pct"),
                             weighted("kpi_017_low_speed_rate_pct"))
    cells = valid if "sum_km" in valid.columns else stored(duration_cells(valid, []), "duration-cells")
    points = cell_percentiles(cells, {"median": 0.5, "p90": 0.9})
    overall = cells.agg(
        avg_duration(1, 60).alias("avg_min"), avg_km(2).alias("avg_km"), avg_kmh(1).alias("avg_kmh"))
    busiest = (demand.orderBy(F.col("kpi_009_peak_hour_trip_count").desc(), "pickup_date")
               .limit(1).select("kpi_009_peak_hour"))
    score = quality.agg(pct(F.sum("valid_records"), F.sum("total_records"), 2)
                        .alias("kpi_018_data_quality_pct"))
    tiles = valid.sparkSession.range(1).select(
        _one_value(totals).alias("t"), _one_value(overall).alias("o"),
        _one_value(points).alias("p"), _one_value(busiest).alias("b"), _one_value(score).alias("s"))
    return tiles.select(
        "t.kpi_001_total_trips",
        F.col("o.avg_min").alias("kpi_002_avg_duration_min"),
        _shown(F.col("p.median"), 1, divisor=60).alias("kpi_003_median_duration_min"),
        _shown(F.col("p.p90"), 1, divisor=60).alias("kpi_004_p90_duration_min"),
        F.col("o.avg_km").alias("kpi_005_avg_estimated_distance_km"),
        F.col("o.avg_kmh").alias("kpi_006_avg_estimated_speed_kmh"),
        "b.kpi_009_peak_hour",
        "t.kpi_016_long_trip_rate_pct", "t.kpi_017_low_speed_rate_pct",
        "s.kpi_018_data_quality_pct",
    )


def demand_trend(demand: DataFrame) -> DataFrame:
    return (demand.groupBy("pickup_date", "pickup_hour")
            .agg(F.sum("kpi_008_trips_per_hour").alias("trips_per_hour"),
                 F.max("kpi_007_trips_per_day").alias("trips_per_day"))
            .orderBy("pickup_date", "pickup_hour"))


def daily_trend(trend: DataFrame) -> DataFrame:
    return (trend.groupBy("pickup_date").agg(F.max("trips_per_day").alias("trips_per_day"))
            .orderBy("pickup_date"))


def hour_profile(trend: DataFrame) -> DataFrame:
    return (trend.groupBy("pickup_hour").agg(F.sum("trips_per_hour").alias("trips"))
            .orderBy("pickup_hour"))


def top_areas_routes(ranked: DataFrame, limit: int = 10, dimension: str | None = None) -> DataFrame:
    """Best areas and routes, or one dimension of them."""
    rows = ranked.where(F.col("rank_in_dimension") <= limit)
    if dimension is not None:
        rows = rows.where(F.col("dimension") == dimension)
    return rows.select(
        "dimension", "area_key", "trip_count",
        _minutes("avg_duration_seconds").alias("avg_duration_min"),
        _minutes("median_duration_seconds").alias("median_duration_min"),
        _minutes("p90_duration_seconds").alias("p90_duration_min"),
        _shown(F.col("avg_estimated_distance_km"), 2, 6).alias("avg_estimated_distance_km"),
        _shown(F.col("avg_estimated_speed_kmh"), 1, 6).alias("avg_estimated_speed_kmh"),
        "rank_in_dimension",
    ).orderBy("dimension", "rank_in_dimension")


def vendor_comparison(vendors: DataFrame) -> DataFrame:
    return vendors.select(
        "vendor_id", "vendor_trips",
        _shown(F.col("kpi_013_vendor_trip_share_pct"), 2).alias("trip_share_pct"),
        _minutes("kpi_014_avg_duration_seconds").alias("avg_duration_min"),
        _minutes("median_duration_seconds").alias("median_duration_min"),
        _minutes("kpi_015_p90_duration_seconds").alias("p90_duration_min"),
        _shown(F.col("avg_estimated_distance_km"), 2, 6).alias("avg_estimated_distance_km"),
        _shown(F.col("avg_estimated_speed_kmh"), 1, 6).alias("avg_estimated_speed_kmh"),
    ).orderBy("vendor_id")


def dq_panel(quality: DataFrame) -> DataFrame:
    shown = {
        "kpi_018_quality_score_pct": "kpi_018_data_quality_score_pct",
        "kpi_019_invalid_rate_pct": "kpi_019_invalid_record_rate_pct",
        "kpi_020_duplicate_rate_pct": "kpi_020_duplicate_rate_pct",
        "completeness_pct": "completeness_score_pct",
        "uniqueness_pct": "uniqueness_score_pct",
        "validity_pct": "validity_score_pct",
        "consistency_pct": "consistency_score_pct",
        "geographic_validity_pct": "geographic_validity_score_pct",
    }
    return quality.select(
        "source_hash", "source_file", "total_records", "valid_records", "quarantined_records",
        "duplicate_records",
        *[_shown(F.col(stored), 3).alias(name) for name, stored in shown.items()],
        "reconciles",
    ).orderBy("source_hash")


def quarantine_breakdown(quarantine: DataFrame, total_records: DataFrame) -> DataFrame:
    """Rejected rows by rule, as a share of all records; ``total_records`` has one value."""
    by_rule = (quarantine.groupBy("rule_id", "quarantine_reason")
               .agg(F.count("*").alias("rejected_rows")))
    return (by_rule.withColumn("pct_of_batch", pct(F.col("rejected_rows"), total_records.scalar()))
            .orderBy(F.col("rejected_rows").desc(), "rule_id"))


def panel_agreement(tiles: DataFrame, trend: DataFrame, valid: DataFrame) -> DataFrame:
    """The tile, the trend and the valid table must show the same number of trips."""
    numbers = valid.sparkSession.range(1).select(
        tiles.select("kpi_001_total_trips").scalar().alias("tile_trips"),
        trend.agg(F.sum("trips_per_hour")).scalar().alias("trend_trips"),
        valid.agg(F.count("*")).scalar().alias("valid_rows"))
    return numbers.withColumn("agrees", (F.col("tile_trips") == F.col("trend_trips"))
                              & (F.col("trend_trips") == F.col("valid_rows")))


