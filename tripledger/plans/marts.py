"""The five KPI tables.

Every mart over valid trips counts rows, not distinct ids: an id occurs once in the valid table
by rule DQ-002, so the counts are equal and no distinct shuffle is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from tripledger.config import Settings, gate, withheld_column
from tripledger.functions.calendar import is_weekend
from tripledger.functions.geo import route
from tripledger.functions.rounding import pct
from tripledger.operators.histogram import (
    avg_duration, avg_km, avg_kmh, duration_cells, duration_percentiles, n_trips, with_percentiles,
)
from tripledger.operators.rank_index import RankIndex
from tripledger.operators.ranking import rank_by_count
from tripledger.operators.rules import CHECKED, COMPONENTS, REJECTING, UNIQUE, passes
from tripledger.sources.stages import stored

TRIP_PERFORMANCE_KEYS = ("pickup_date", "vendor_id", "time_of_day", "day_of_week", "is_weekend")


def _weekday_of(date: str) -> dict:
    """Weekday columns follow from the date, so they are added after the grouping by date."""
    return {"day_of_week": F.date_format(date, "EEEE"), "is_weekend": is_weekend(F.col(date))}


def _kpi_values(settings: Settings) -> list:
    """KPI-001..006, 016 and 017 over duration cells; needs ``p`` for the two percentiles."""
    long_limit = settings.get("long_trip_seconds")
    median, p90 = F.col("p")[0], F.col("p")[1]
    if long_limit is None:
        long_rate = F.lit(None).cast("double").alias(withheld_column("KPI-016", "long_trip_seconds"))
    else:
        long_rate = pct(F.col("n_long"), F.col("row_count")).alias("kpi_016_long_trip_rate_pct")
    if settings.get("low_speed_kmh") is None:
        slow_rate = F.lit(None).cast("double").alias(withheld_column("KPI-017", "low_speed_kmh"))
    else:
        slow_rate = pct(F.col("n_slow"), F.col("n_kmh")).alias("kpi_017_low_speed_rate_pct")
    return [
        F.col("row_count").alias("kpi_001_total_trips"),
        "kpi_002_avg_duration_seconds", "kpi_002_avg_duration_minutes",
        F.round(median, 4).alias("kpi_003_median_duration_seconds"),
        F.round(median / 60, 4).alias("kpi_003_median_duration_minutes"),
        F.round(p90, 4).alias("kpi_004_p90_duration_seconds"),
        F.round(p90 / 60, 4).alias("kpi_004_p90_duration_minutes"),
        "kpi_005_avg_estimated_distance_km", "kpi_006_avg_estimated_speed_kmh",
        long_rate, slow_rate, "row_count",
    ]


def trip_cells(valid: DataFrame, settings: Settings) -> DataFrame:
    """Trips counted by date, hour, part of day, vendor and duration: what all figures of a dashboard
    can be added up from, at a few rows a group whatever the number of trips."""
    return duration_cells(valid, ["pickup_date", "pickup_hour", "time_of_day", "vendor_id"],
                          settings.get("low_speed_kmh"))


def kpi_table(valid: DataFrame, keys: list[str], settings: Settings) -> DataFrame:
    """The trip-performance KPIs for any list of grouping columns.

    A group may be anything up to all trips, so percentiles come from an index of ranks."""
    cells = stored(duration_cells(valid, keys, settings.get("low_speed_kmh")), "duration-cells")
    sums = RankIndex(cells, keys, "trip_duration").added_to(
        _sums(cells.groupBy(*keys), settings), {"median": 0.5, "p90": 0.9})
    return sums.withColumn("p", F.array("median", "p90")).select(*keys, *_kpi_values(settings))


def summarise_cells(groups: GroupedData, keys: list[str], settings: Settings,
                    *extra: Column) -> DataFrame:
    """KPI values of grouped duration cells, for many groups of a bounded number of durations."""
    grouped = _sums(groups, settings, *extra, duration_percentiles([0.5, 0.9]).alias("p"))
    named = grouped.columns[len(keys):len(keys) + len(extra)]
    return grouped.select(*keys, *named, *_kpi_values(settings))


def _sums(groups: GroupedData, settings: Settings, *extra: Column) -> DataFrame:
    long_limit = settings.get("long_trip_seconds")
    over = F.lit(False) if long_limit is None else F.col("trip_duration") > long_limit
    return groups.agg(
        *extra,
        n_trips().alias("row_count"),
        avg_duration(4).alias("kpi_002_avg_duration_seconds"),
        avg_duration(4, 60).alias("kpi_002_avg_duration_minutes"),
        avg_km().alias("kpi_005_avg_estimated_distance_km"),
        avg_kmh().alias("kpi_006_avg_estimated_speed_kmh"),
        F.sum(F.when(over, F.col("n")).otherwise(0)).alias("n_long"),
        F.sum("n_slow").alias("n_slow"),
        F.sum("n_kmh").alias("n_kmh"),
    )


def trip_performance(valid: DataFrame, settings: Settings,
                     allow_withheld: bool = False) -> DataFrame:
    """One row per date, vendor, part of day, weekday and weekend flag."""
    return trip_performance_of(duration_cells(
        valid, ["pickup_date", "vendor_id", "time_of_day"], settings.get("low_speed_kmh")),
        settings, allow_withheld)


def trip_performance_of(cells: DataFrame, settings: Settings, allow_withheld: bool = False) -> DataFrame:
    """The same from duration cells that have at least date, vendor and part of day."""
    gate(settings, allow_withheld)
    keys = ["pickup_date", "vendor_id", "time_of_day"]
    by_date = summarise_cells(cells.groupBy(*keys), keys, settings)
    values = [c for c in by_date.columns if c not in TRIP_PERFORMANCE_KEYS]
    return (by_date.withColumns(_weekday_of("pickup_date"))
            .select(*TRIP_PERFORMANCE_KEYS, *values))


def demand_metrics(valid: DataFrame) -> DataFrame:
    """Trips per date, hour, vendor and weekday, with the day's total and peak hour.

    The peak counts all vendors; among equal hours the earliest wins. The windows run over
    counted hours, at most 24 per date and vendor.
    """
    return _demand(valid.groupBy("pickup_date", "pickup_hour", "vendor_id")
                   .agg(F.count("id").alias("kpi_008_trips_per_hour")))


def demand_of(cells: DataFrame) -> DataFrame:
    """The same from duration cells that have at least date, hour and vendor."""
    return _demand(cells.groupBy("pickup_date", "pickup_hour", "vendor_id")
                   .agg(F.sum("n").alias("kpi_008_trips_per_hour")))


def _demand(hours: DataFrame) -> DataFrame:
    day = Window.partitionBy("pickup_date")
    hour_total = F.sum("kpi_008_trips_per_hour").over(
        Window.partitionBy("pickup_date", "pickup_hour"))
    peak = F.min(F.struct((-F.col("hour_total")).alias("minus_n"), "pickup_hour")).over(day)
    return hours.withColumn("hour_total", hour_total).select(
        "pickup_date", "pickup_hour", "vendor_id",
        _weekday_of("pickup_date")["day_of_week"].alias("day_of_week"), "kpi_008_trips_per_hour",
        F.sum("kpi_008_trips_per_hour").over(day).alias("kpi_007_trips_per_day"),
        peak["pickup_hour"].alias("kpi_009_peak_hour"),
        (-peak["minus_n"]).alias("kpi_009_peak_hour_trip_count"),
    )


ROUTE_KEYS = ("pickup_lat_cell", "pickup_lon_cell", "dropoff_lat_cell", "dropoff_lon_cell")


def _cell_text(end: str):
    return F.concat(F.col(f"{end}_lat_cell").cast("string"), F.lit(","),
                    F.col(f"{end}_lon_cell").cast("string"))


def route_cells(valid: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Trips counted by route and duration, and by further ``keys``. Areas stay numbers until the
    counting is done."""
    cells = valid.withColumns({
        "pickup_lat_cell": F.round("pickup_latitude", 2),
        "pickup_lon_cell": F.round("pickup_longitude", 2),
        "dropoff_lat_cell": F.round("dropoff_latitude", 2),
        "dropoff_lon_cell": F.round("dropoff_longitude", 2),
    })
    return duration_cells(cells, [*keys, *ROUTE_KEYS])


def area_counts(valid: DataFrame) -> DataFrame:
    """Unranked rows of the geographic mart.

    Trips are grouped once, by route; both area counts are sums over routes.
    """
    return area_counts_of(route_cells(valid))


def area_counts_of(cells: DataFrame) -> DataFrame:
    """The same from route cells."""
    routes = cells.groupBy(*ROUTE_KEYS).agg(
        n_trips().alias("trip_count"),
        avg_duration(4).alias("avg_duration_seconds"),
        duration_percentiles([0.5, 0.9]).alias("p"),
        avg_km().alias("avg_estimated_distance_km"),
        avg_kmh().alias("avg_estimated_speed_kmh"),
    )
    routes = routes.select(
        _cell_text("pickup").alias("pickup_area"), _cell_text("dropoff").alias("dropoff_area"),
        "trip_count", "avg_duration_seconds",
        F.round(F.col("p")[0], 4).alias("median_duration_seconds"),
        F.round(F.col("p")[1], 4).alias("p90_duration_seconds"),
        "avg_estimated_distance_km", "avg_estimated_speed_kmh",
    )
    ends = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("area_key"))
                     for d in ("pickup_area", "dropoff_area")])
    no_value = F.lit(None).cast("double")
    areas = (routes.select("trip_count", F.inline(ends)).groupBy("dimension", "area_key")
             .agg(F.sum("trip_count").alias("trip_count")))
    companions = ("avg_duration_seconds", "median_duration_seconds", "p90_duration_seconds",
                  "avg_estimated_distance_km", "avg_estimated_speed_kmh")
    areas = areas.withColumns({c: no_value for c in companions}).withColumn("head", F.col("area_key"))
    by_route = routes.select(
        F.lit("route").alias("dimension"),
        route(F.col("pickup_area"), F.col("dropoff_area")).alias("area_key"),
        "trip_count", *companions, F.col("pickup_area").alias("head"))
    return areas.unionByName(by_route)


def geographic_metrics(valid: DataFrame) -> DataFrame:
    """Pickup areas, drop-off areas and routes, ranked by trips inside each dimension."""
    return geographic_metrics_of(route_cells(valid))


def geographic_metrics_of(cells: DataFrame) -> DataFrame:
    """The same from route cells."""
    ranked = rank_by_count(stored(area_counts_of(cells), "area-counts"), "dimension", "trip_count", "head", "area_key",
                           "rank_in_dimension")
    return ranked.drop("head")


def top_areas(valid: DataFrame, limit: int) -> DataFrame:
    """The best rows per dimension; the row-number filter prunes inside each task first."""
    best = Window.partitionBy("dimension").orderBy(F.col("trip_count").desc(), "area_key")
    return (area_counts(valid).withColumn("rank_in_dimension", F.row_number().over(best))
            .where(F.col("rank_in_dimension") <= limit).drop("head")
            .withColumn("rank_in_dimension", F.col("rank_in_dimension").cast("bigint")))


def vendor_performance(valid: DataFrame) -> DataFrame:
    """Share, durations, distance and speed per vendor; the total is a sum over vendors."""
    return vendor_performance_of(stored(duration_cells(valid, ["vendor_id"]), "duration-cells"))


def vendor_performance_of(cells: DataFrame) -> DataFrame:
    """The same from a stored table of cells by vendor and duration."""
    per_vendor = cells.groupBy("vendor_id").agg(
        n_trips().alias("vendor_trips"),
        avg_duration(4).alias("kpi_014_avg_duration_seconds"),
        avg_duration(4, 60).alias("kpi_014_avg_duration_minutes"),
        avg_km().alias("avg_estimated_distance_km"),
        avg_kmh().alias("avg_estimated_speed_kmh"),
    )
    median, p90 = F.col("median"), F.col("p90")
    with_points = with_percentiles(per_vendor, cells, {"median": 0.5, "p90": 0.9}, "vendor_id")
    totals = with_points.withColumn("total_trips",
                                   per_vendor.agg(F.sum("vendor_trips")).scalar())
    return totals.select(
        "vendor_id", "vendor_trips", "total_trips",
        pct(F.col("vendor_trips"), F.col("total_trips")).alias("kpi_013_vendor_trip_share_pct"),
        "kpi_014_avg_duration_seconds", "kpi_014_avg_duration_minutes",
        F.round(p90, 4).alias("kpi_015_p90_duration_seconds"),
        F.round(p90 / 60, 4).alias("kpi_015_p90_duration_minutes"),
        F.round(median, 4).alias("median_duration_seconds"),
        "avg_estimated_distance_km", "avg_estimated_speed_kmh",
    )


def component_counts() -> dict:
    """Rows that pass every rule of a component, one count per component."""
    return {
        component: F.count_if(passes(*[r for r in CHECKED if r.component == component]))
        for component in COMPONENTS
    }


def data_quality(judged: DataFrame, valid: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Quality per batch over all rows.

    Valid and quarantined rows are counted in their own tables, so a row that reached neither
    shows up in ``reconciles``. Duplicates are counted before rejection; a missing id is not one.
    """
    everything = judged.groupBy("source_hash").agg(
        F.min("source_file").alias("source_file"),
        F.count("*").alias("total_records"),
        F.count_if(F.col("id_occurrences") > 1).alias("duplicate_records"),
        *[c.alias(name) for name, c in component_counts().items()],
    )
    kept = valid.groupBy("source_hash").agg(F.count("*").alias("kept"))
    sent_away = quarantine.groupBy("source_hash").agg(F.count("*").alias("sent_away"))
    zero = F.lit(0).cast("bigint")
    return _quality(everything.join(kept, "source_hash", "left").join(sent_away, "source_hash", "left")
               .withColumns({"valid_records": F.coalesce("kept", zero),
                             "quarantined_records": F.coalesce("sent_away", zero)}))


def data_quality_of(counts: DataFrame) -> DataFrame:
    """The same from (source_hash, source_file, failed_rules, n): rows counted by the rules they fail.
    A row is valid or quarantined by its own rules here."""
    n, zero = F.col("n"), F.lit(0).cast("bigint")

    def rows_that(passed: Column) -> Column:
        return F.coalesce(F.sum(F.when(passed, n)), zero)
    return _quality(counts.groupBy("source_hash").agg(
        F.min("source_file").alias("source_file"), F.sum("n").alias("total_records"),
        rows_that(~passes(UNIQUE)).alias("duplicate_records"),
        *[rows_that(passes(*[r for r in CHECKED if r.component == c])).alias(c) for c in COMPONENTS],
        rows_that(passes(*REJECTING)).alias("valid_records"),
        rows_that(~passes(*REJECTING)).alias("quarantined_records")))


def _quality(counted: DataFrame) -> DataFrame:
    total = F.col("total_records")
    scores = [pct(F.col(c), total).alias(f"{c}_score_pct") for c in COMPONENTS]
    return counted.select(
        "source_hash", "source_file", "total_records", "valid_records", "quarantined_records",
        "duplicate_records",
        pct(F.col("valid_records"), total).alias("kpi_018_data_quality_score_pct"),
        pct(F.col("quarantined_records"), total).alias("kpi_019_invalid_record_rate_pct"),
        pct(F.col("duplicate_records"), total).alias("kpi_020_duplicate_rate_pct"),
        *scores,
        (total == F.col("valid_records") + F.col("quarantined_records")).alias("reconciles"),
    )
