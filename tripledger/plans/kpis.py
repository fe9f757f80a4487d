"""Single KPIs: a column selection over a mart, or a drill-down by allowed dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.config import KPI_BY_ID, Settings
from tripledger.operators.histogram import duration_cells
from tripledger.plans.marts import (
    TRIP_PERFORMANCE_KEYS, demand_metrics, kpi_table, summarise_cells, top_areas,
    vendor_performance,
)

# Dimension names of the KPI contract and the columns that carry them.
DIMENSION_COLUMNS = {
    "date": "pickup_date", "day_of_week": "day_of_week", "hour": "pickup_hour",
    "time_of_day": "time_of_day", "vendor": "vendor_id", "pickup_area": "pickup_area",
    "dropoff_area": "dropoff_area", "route": "route_key",
    "month": "pickup_month", "week": "pickup_week", "weekend": "is_weekend",
}
# Coarser parts of a date, allowed wherever the date is.
_PARTS_OF_DATE = ("month", "week", "weekend")
_TOP_DIMENSION = {"KPI-010": "pickup_area", "KPI-011": "dropoff_area", "KPI-012": "route"}


def from_trip_performance(mart: DataFrame, kpi_id: str) -> DataFrame:
    return mart.select(*TRIP_PERFORMANCE_KEYS, *KPI_BY_ID[kpi_id].columns)


def from_demand(mart: DataFrame, kpi_id: str) -> DataFrame:
    """Hourly trips at their own grain; day values once per date."""
    columns = KPI_BY_ID[kpi_id].columns
    if kpi_id == "KPI-008":
        return mart.select("pickup_date", "pickup_hour", "vendor_id", "day_of_week", *columns)
    return mart.select("pickup_date", *columns).distinct()


def top_of_dimension(valid: DataFrame, kpi_id: str) -> DataFrame:
    dimension = _TOP_DIMENSION[kpi_id]
    return (top_areas(valid, 1).where(F.col("dimension") == dimension)
            .select("dimension", *KPI_BY_ID[kpi_id].columns))


def from_vendor_performance(mart: DataFrame, kpi_id: str) -> DataFrame:
    extra = ("vendor_trips", "total_trips") if kpi_id == "KPI-013" else ()
    return mart.select("vendor_id", *extra, *KPI_BY_ID[kpi_id].columns)


def from_data_quality(mart: DataFrame, kpi_id: str) -> DataFrame:
    counts = {"KPI-018": "valid_records", "KPI-019": "quarantined_records",
              "KPI-020": "duplicate_records"}
    return mart.select("source_hash", "total_records", counts[kpi_id], *KPI_BY_ID[kpi_id].columns)


def drill_down(valid: DataFrame, kpi_id: str, dimensions: Sequence[str],
               settings: Settings) -> DataFrame:
    """One KPI by any of its allowed dimensions, recomputed from trips.

    A KPI of the vendor or area table has its own grain and no further dimension. The quality KPIs
    count rejected rows too, which trips don't have: they come from ``from_data_quality``.
    """
    kpi = KPI_BY_ID[kpi_id]
    allowed = kpi.dimensions + (_PARTS_OF_DATE if "date" in kpi.dimensions else ())
    refused = [d for d in dimensions if d not in allowed]
    if refused:
        raise ValueError(f"{kpi_id} has no dimension {', '.join(refused)}")
    if kpi.threshold:
        settings.require(kpi.threshold)
    if kpi.mart == "data_quality":
        raise ValueError(f"{kpi_id} is not a figure of valid trips: use from_data_quality")
    if kpi.mart == "vendor_performance":
        return from_vendor_performance(vendor_performance(valid), kpi_id)
    if kpi.mart == "geographic_metrics":
        return top_of_dimension(valid, kpi_id)
    if kpi_id == "KPI-009":
        return from_demand(demand_metrics(valid), kpi_id)
    keys = [DIMENSION_COLUMNS[d] for d in dimensions]
    grain = {"KPI-007": ["pickup_date"], "KPI-008": ["pickup_date", "pickup_hour"]}
    if kpi_id in grain:
        return valid.groupBy(*grain[kpi_id], *keys).agg(F.count("id").alias(kpi.columns[0]))
    return kpi_table(valid, keys, settings).select(*keys, *kpi.columns)


def rollup(valid: DataFrame, settings: Settings) -> DataFrame:
    """Totals at every combination of weekday, part of day and vendor, in one pass.

    The cube runs over duration cells, so its row expansion does not touch single trips.
    ``grain`` has a bit set for every column that is totalled, so a total cannot be mistaken
    for a missing value.
    """
    days = valid.withColumn("weekday", F.dayofweek("pickup_date"))
    cells = duration_cells(days, ["weekday", "time_of_day", "vendor_id"],
                           settings.get("low_speed_kmh"))
    cube = cells.cube("weekday", "time_of_day", "vendor_id")
    return summarise_cells(cube, ["weekday", "time_of_day", "vendor_id"], settings,
                           F.grouping_id().cast("int").alias("grain"))
