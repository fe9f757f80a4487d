"""Every query by name: a function of (spark, folder with the input tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.config import PENDING, Settings
from tripledger.functions.geo import cell, route
from tripledger.operators import rules
from tripledger.operators.occurrences import repeated_ids, with_id_occurrences
from tripledger.operators.typing import derived, typed, typed_feed
from tripledger.plans import distributions as dist
from tripledger.plans import expectations as ex
from tripledger.plans import kpis, marts, panels, profile, star
from tripledger.plans.pipeline import GOLD, MODELS, build, valid_rates, write_profile
from tripledger.session import prepare, scratch_dir
from tripledger.sources import feed, landing
from tripledger.sources.contract import SOURCE_COLUMNS
from tripledger.sources.stages import Stages
from tripledger.sources.tables import Store

Query = Callable[[SparkSession, str], DataFrame]
SETTINGS = Settings()
UNSET = Settings(vendor_domain=PENDING, passenger_count_domain=PENDING, nyc_bounds=PENDING,
                 long_trip_seconds=PENDING, low_speed_kmh=PENDING,
                 extreme_duration_seconds=PENDING, extreme_distance_km=PENDING)
# A cutoff of the query, not an approved one: the contract has no upper speed limit.
VERY_HIGH_KMH = 120.0
BUILT = ("silver_trips", "silver_trips_quarantine", *GOLD)
CALENDAR = ("pickup_date", "pickup_year", "pickup_month", "pickup_week", "pickup_day",
            "day_of_week", "pickup_hour", "is_weekend", "time_of_day")


class Frames:
    """The frames the queries share. They are lazy but for the table of repeated ids, and for stage
    tables of what a query reads several times."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS):
        prepare(spark)
        self.spark, self.sf_dir, self.settings = spark, sf_dir, settings
        self.stages = Stages(spark)

    @cached_property
    def feed(self) -> DataFrame:
        return feed.trips(self.spark, self.sf_dir).drop("h")

    @cached_property
    def landed(self) -> DataFrame:
        return feed.raw_trips(self.spark, self.sf_dir)

    @cached_property
    def typed(self) -> DataFrame:
        return typed_feed(self.feed)

    @cached_property
    def trips(self) -> DataFrame:
        return derived(self.typed)

    @cached_property
    def repeated(self) -> DataFrame:
        return repeated_ids(self.typed)

    @cached_property
    def judged(self) -> DataFrame:
        return rules.evaluate(self.typed, self.settings, self.repeated)

    @cached_property
    def quarantine(self) -> DataFrame:
        return rules.quarantined(self.judged)

    @cached_property
    def valid(self) -> DataFrame:
        return rules.valid_trips(self.typed, self.settings, self.repeated)

    @cached_property
    def cells(self) -> DataFrame:
        """The valid trips as counted cells, a stage table."""
        return self.stages.table(marts.trip_cells(self.valid, self.settings), "trip-cells")

    @cached_property
    def trip_performance(self) -> DataFrame:
        return marts.trip_performance(self.valid, self.settings)

    @cached_property
    def demand(self) -> DataFrame:
        return marts.demand_metrics(self.valid)

    @cached_property
    def vendors(self) -> DataFrame:
        return marts.vendor_performance(self.valid)

    @cached_property
    def quality(self) -> DataFrame:
        return marts.data_quality(self.judged, self.valid, self.quarantine)

    @cached_property
    def trend(self) -> DataFrame:
        return panels.demand_trend(self.demand)

    @cached_property
    def tiles(self) -> DataFrame:
        return panels.exec_tiles(self.cells, marts.trip_performance_of(self.cells, self.settings),
                                 marts.demand_of(self.cells), self.quality)

    def write_inbox(self, by_batch: bool = False) -> str:
        """The landing text as CSV files in a fresh shared folder."""
        path = scratch_dir(self.spark, "inbox")
        out = self.landed.select(*SOURCE_COLUMNS, F.col("source_hash").alias("batch"))
        writer = (out if by_batch else out.drop("batch")).write.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        (writer.partitionBy("batch") if by_batch else writer).csv(path)
        return path

    def landing(self) -> landing.Landing:
        return landing.Landing(self.spark, scratch_dir(self.spark, "landing"))


def _bronze_rows(f: Frames) -> DataFrame:
    path = f.write_inbox()
    heads = landing.headers(landing.list_files(f.spark, path))
    return landing.read_text_rows(f.spark, path, heads).select(*SOURCE_COLUMNS)


def _bronze_stamp(f: Frames) -> DataFrame:
    store = f.landing()
    store.land(f.write_inbox())
    return store.rows().agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("source_file").isNull()).alias("without_file"),
        F.count_if(F.coalesce(F.length("source_hash") != 64, F.lit(True))).alias("without_hash"),
        F.countDistinct("ingested_at").alias("load_times"))


def _landed_twice(f: Frames, force: bool) -> DataFrame:
    inbox, store = f.write_inbox(), f.landing()
    store.land(inbox)
    first = store.rows().agg(F.count("*"))
    stored = f.spark.createDataFrame([(first.first()[0],)], "rows_after_first bigint")
    store.land(inbox, force=force)
    again = store.rows().agg(F.count("*").alias("rows_after_second"),
                             F.countDistinct("load_id").alias("loads"))
    return again.select(stored.scalar().alias("rows_after_first"), "rows_after_second", "loads")


def _ingest_log(f: Frames) -> DataFrame:
    inbox, store = f.write_inbox(by_batch=True), f.landing()
    loads = [(store.land(f"{inbox}/batch={b}"), b) for b in ("batch_a", "batch_b")]
    names = f.spark.createDataFrame(loads, "load_id string, batch string")
    return (landing.running_totals(store.log()).join(names, "load_id")
            .select("batch", "rows", "rows_in_total"))


def _batch() -> Column:
    return F.regexp_extract("file_path", "batch=([a-z_]+)", 1).alias("batch")


def _file_hash(f: Frames) -> DataFrame:
    """Per batch: whether every hash has 64 digits and is that of the bytes Spark reads."""
    files = landing.list_files(f.spark, f.write_inbox(by_batch=True))
    read = files.select("file_path", F.sha2("content", 256).alias("of_bytes"))
    return (landing.file_hashes(files).join(read, "file_path").groupBy(_batch()).agg(
        F.bool_and(F.length("source_hash") == 64).alias("full_length"),
        F.bool_and(F.col("source_hash") == F.col("of_bytes")).alias("of_the_bytes")))


def _file_profile(f: Frames) -> DataFrame:
    found = landing.file_profile(f.spark, f.write_inbox(by_batch=True))
    return found.groupBy(_batch(), "format", "encoding", "compression").agg(
        F.sum("rows").alias("rows"), F.max("columns").alias("columns"),
        F.bool_and("header_present").alias("header_present"),
        F.bool_and(F.col("bytes") > 0).alias("has_bytes"))


def _schema_drift(f: Frames) -> DataFrame:
    """A folder for each passenger count. Its number of trips, modulo 4, tells whether its files are as
    agreed, turned round, one column short or one too many."""
    rows = f.stages.table(f.landed.select(*SOURCE_COLUMNS), "drift-rows")
    sizes = rows.groupBy("passenger_count").agg((F.count("*") % 4).alias("variant"))
    dealt = rows.join(F.broadcast(sizes), "passenger_count").withColumn(
        "group", F.concat(F.lit("g"), "passenger_count"))
    given = [SOURCE_COLUMNS, SOURCE_COLUMNS[::-1],
             [c for c in SOURCE_COLUMNS if c != "trip_duration"], [*SOURCE_COLUMNS, "tip"]]
    found = []
    for variant, columns in enumerate(given):
        path = scratch_dir(f.spark, "drift")
        (dealt.where(F.col("variant") == variant).withColumn("tip", F.lit("0"))
         .select("group", *columns).write.partitionBy("group").option("header", True).csv(path))
        heads = landing.headers(landing.list_files(f.spark, path))
        found.append(landing.schema_drift(heads).select(
            F.regexp_extract("file_path", "group=(g[0-9]*)", 1).alias("folder"), "profile_status",
            "in_order", F.array_join("missing", ",").alias("missing"),
            F.array_join("unexpected", ",").alias("unexpected")))
    return reduce(DataFrame.unionAll, found).distinct()


def _build(f: Frames, store: Store) -> dict[str, DataFrame]:
    return build(f.landed, store, f.settings)


def _built(name: str):
    """A table of the whole build, from landing text to the store and read back."""
    return lambda f: _build(f, Store(f.spark, scratch_dir(f.spark, "build")))[name]


def _gold_idempotent(f: Frames) -> DataFrame:
    """Each mart of two builds into the same store, the second from the rows in another order.

    The rows are put in that order once, as a stored table, since judging reads them several times.
    Only the marts are compared: what they are made of leaves the store with its last reader, so the
    silver tables of the two builds are never there together.
    """
    store = Store(f.spark, scratch_dir(f.spark, "build"))
    once = build(f.landed, store, f.settings, keep=GOLD)
    shuffled = store.replace("bronze", "trips", f.landed.repartition("pickup_longitude", "passenger_count"))
    judged = "silver_dq_evaluated"
    build(shuffled, store, f.settings, select=[judged])
    store.drop("bronze", "trips")
    again = build(shuffled, store, f.settings, select=[m for m in MODELS if m != judged], parents=False,
                  keep=GOLD)
    return reduce(DataFrame.unionAll, [
        ex.compare(once[name], again[name]).select(F.lit(name).alias("mart"), "*")
        for name in GOLD])


def _calendar(f: Frames) -> DataFrame:
    return f.trips.select("id", "trip_duration_minutes", *CALENDAR)


def _cells(f: Frames) -> DataFrame:
    start = cell(F.col("pickup_latitude"), F.col("pickup_longitude"))
    end = cell(F.col("dropoff_latitude"), F.col("dropoff_longitude"))
    return f.typed.select("id", start.alias("pickup_area"), end.alias("dropoff_area"),
                          route(start, end).alias("route_key"))


def _evaluated(f: Frames) -> DataFrame:
    return f.judged.select("id", "source_hash", *[r.column for r in rules.CHECKED],
                           *[r.outcome for r in rules.FLAGGING], "coordinate_anomaly",
                           "rule_id", "quarantine_reason", "is_valid_trip")


def _expect_not_null(f: Frames) -> DataFrame:
    return ex.offences({
        "silver_trips.id": ex.expect_not_null(f.valid, "id"),
        "silver_trips.trip_duration": ex.expect_not_null(f.valid, "trip_duration"),
        "quarantine.rule_id": ex.expect_not_null(f.quarantine, "rule_id"),
        "trip_performance.kpi_001_total_trips":
            ex.expect_not_null(f.trip_performance, "kpi_001_total_trips"),
        "geographic_metrics.dimension":
            ex.expect_not_null(marts.area_counts(f.valid), "dimension"),
        "vendor_performance.vendor_id": ex.expect_not_null(f.vendors, "vendor_id"),
        "data_quality.source_hash": ex.expect_not_null(f.quality, "source_hash"),
        "silver_typed.id": ex.expect_not_null(f.typed, "id"),
    })


def _expect_unique(f: Frames) -> DataFrame:
    return ex.offences({
        "silver_trips.id": ex.expect_unique(f.valid, "id"),
        "vendor_performance.vendor_id": ex.expect_unique(f.vendors, "vendor_id"),
        "data_quality.source_hash": ex.expect_unique(f.quality, "source_hash"),
        "silver_typed.id": ex.expect_unique(f.typed, "id"),
    })


def _expect_accepted(f: Frames) -> DataFrame:
    return ex.offences({
        "quarantine.rule_id": ex.expect_accepted(f.quarantine, "rule_id", ex.REJECTING_RULE_IDS),
        "demand_metrics.kpi_009_peak_hour":
            ex.expect_accepted(f.demand, "kpi_009_peak_hour", range(24)),
        "geographic_metrics.dimension":
            ex.expect_accepted(marts.area_counts(f.valid), "dimension", ex.DIMENSIONS),
        "data_quality.reconciles": ex.expect_accepted(f.quality, "reconciles", [True]),
        "silver_typed.vendor_id":
            ex.expect_accepted(f.typed, "vendor_id", SETTINGS.require("vendor_domain")),
    })


def _kpi_by_dims(f: Frames) -> DataFrame:
    return kpis.drill_down(f.valid, "KPI-004", ["hour", "vendor"], f.settings)


def _kpi_by_area(f: Frames) -> DataFrame:
    return kpis.drill_down(f.valid, "KPI-005", ["pickup_area", "vendor"], f.settings)


def _kpi_per_day_by_part(f: Frames) -> DataFrame:
    return kpis.drill_down(f.valid, "KPI-007", ["time_of_day", "vendor"], f.settings)


def _star_rows(f: Frames) -> DataFrame:
    return f.stages.table(f.valid.select(*star.SOURCE), "star-rows")


def _star_schema(f: Frames) -> DataFrame:
    rows = _star_rows(f)
    fact, places = star.fact_trip(rows), star.dim_location(rows)
    return star.trips_by_month_and_area(fact, star.dim_date(rows), star.dim_time(rows), places)


def _star_sizes(f: Frames) -> DataFrame:
    rows = _star_rows(f)
    fact, places = star.fact_trip(rows), star.dim_location(rows)
    tables = {"fact_trip": fact, "dim_date": star.dim_date(rows),
              "dim_time": star.dim_time(rows), "dim_vendor": star.dim_vendor(rows),
              "dim_location": places, "dim_route": star.dim_route(fact, places)}
    return ex.offences(tables).withColumnsRenamed({"check": "table", "offending_rows": "rows"})


def _valid_rate_drift(f: Frames) -> DataFrame:
    """The same batches judged without the pending parameters and then with the approved ones."""
    before = Frames(f.spark, f.sf_dir, UNSET)
    runs = valid_rates(before.quality, 1).unionByName(valid_rates(f.quality, 2))
    return dist.valid_rate_drift(runs)


def _unset_params(f: Frames) -> DataFrame:
    return profile.rule_counts(Frames(f.spark, f.sf_dir, UNSET).judged)


def _withheld(f: Frames) -> DataFrame:
    return marts.trip_performance(Frames(f.spark, f.sf_dir, UNSET).valid, UNSET,
                                  allow_withheld=True)


def _mart_kpi(mart: str, select: Callable[[DataFrame, str], DataFrame], kpi_id: str):
    return lambda f: select(getattr(f, mart), kpi_id)


_KPI_QUERIES = {
    **{f"kpi_{n:03}": _mart_kpi("trip_performance", kpis.from_trip_performance, f"KPI-{n:03}")
       for n in (1, 2, 3, 4, 5, 6, 16, 17)},
    **{f"kpi_{n:03}": _mart_kpi("demand", kpis.from_demand, f"KPI-{n:03}") for n in (7, 8, 9)},
    **{f"kpi_{n:03}": _mart_kpi("valid", kpis.top_of_dimension, f"KPI-{n:03}")
       for n in (10, 11, 12)},
    **{f"kpi_{n:03}": _mart_kpi("vendors", kpis.from_vendor_performance, f"KPI-{n:03}")
       for n in (13, 14, 15)},
    **{f"kpi_{n:03}": _mart_kpi("quality", kpis.from_data_quality, f"KPI-{n:03}")
       for n in (18, 19, 20)},
}

_QUERIES: dict[str, Callable[[Frames], DataFrame]] = {
    # landing
    "trip_feed": lambda f: f.feed,
    "bronze_rows": _bronze_rows,
    "bronze_stamp": _bronze_stamp,
    "file_hash": _file_hash,
    "file_profile": _file_profile,
    "bronze_idempotent": lambda f: _landed_twice(f, force=False),
    "bronze_force_replay": lambda f: _landed_twice(f, force=True),
    "ingest_log": _ingest_log,
    "schema_drift": _schema_drift,
    # typing and derivation
    "silver_typed": lambda f: typed(f.landed),
    "calendar_fields": _calendar,
    "time_of_day": lambda f: f.trips.groupBy("time_of_day", "is_weekend")
    .agg(F.count("*").alias("trips")),
    "haversine": lambda f: f.trips.select("id", "estimated_distance_km"),
    "duration_consistency": lambda f: f.trips.select(
        "id", "trip_duration", "observed_duration_seconds", "duration_difference_seconds"),
    "speed": lambda f: f.trips.select("id", "trip_duration", "estimated_speed_kmh"),
    "geo_cells": _cells,
    # rules and split
    "id_occurrences": lambda f: with_id_occurrences(f.typed.select("id", "source_hash")),
    "dq_evaluated": _evaluated,
    "dq_rule_pass_counts": lambda f: profile.rule_counts(f.judged),
    "dq_unset_params": _unset_params,
    "dq_flags": lambda f: profile.flag_counts(f.judged),
    "geo_anomaly_class": lambda f: f.judged.groupBy("coordinate_anomaly").agg(
        F.count("*").alias("rows"), F.count_if("is_valid_trip").alias("valid_rows")),
    "silver_trips": lambda f: f.valid,
    "quarantine": lambda f: f.quarantine,
    "outlier_flags": lambda f: f.valid.select("id", "is_duration_outlier", "is_speed_outlier"),
    "audit_overlap": lambda f: ex.audit_overlap(f.valid, f.quarantine),
    # marts
    "trip_performance": lambda f: f.trip_performance,
    "trip_perf_withheld": _withheld,
    "demand_metrics": lambda f: f.demand,
    "geographic_metrics": lambda f: marts.geographic_metrics(f.valid),
    "vendor_performance": lambda f: f.vendors,
    "data_quality": lambda f: f.quality,
    "dq_component_scores": lambda f: profile.component_scores(f.quality),
    "gold_idempotent": _gold_idempotent,
    **{f"build_{name}": _built(name) for name in BUILT},
    **_KPI_QUERIES,
    "kpi_by_dims": _kpi_by_dims,
    "kpi_by_area": _kpi_by_area,
    "kpi_per_day_by_part": _kpi_per_day_by_part,
    "kpi_rollup": lambda f: kpis.rollup(f.valid, f.settings),
    # panels
    "exec_tiles": lambda f: f.tiles,
    "demand_trend": lambda f: f.trend,
    "daily_trend": lambda f: panels.daily_trend(f.trend),
    "hour_profile": lambda f: panels.hour_profile(f.trend),
    "top_areas_routes": lambda f: panels.top_areas_routes(marts.top_areas(f.valid, 10)),
    "top_pickup_areas": lambda f: panels.top_areas_routes(
        marts.top_areas(f.valid, 10), dimension="pickup_area"),
    "vendor_comparison": lambda f: panels.vendor_comparison(f.vendors),
    "dq_panel": lambda f: panels.dq_panel(f.quality),
    "quarantine_breakdown": lambda f: panels.quarantine_breakdown(
        f.quarantine, f.typed.agg(F.count("*"))),
    "panel_agreement": lambda f: panels.panel_agreement(f.tiles, f.trend, f.valid),
    # profiling
    "profile_run": lambda f: profile.profile_run(f.landed, "PROFILE_CHECK", datetime(2024, 1, 2)),
    "profile_schema": lambda f: profile.profile_schema(f.landed),
    "profile_uniqueness": lambda f: profile.profile_uniqueness(f.landed),
    "profile_exact_dups": lambda f: profile.exact_duplicates(f.landed),
    "profile_domain_stats": lambda f: profile.profile_domain_stats(f.landed),
    "duration_consistency_stats": lambda f: profile.duration_consistency_stats(f.trips),
    "profile_by_hour": lambda f: profile.trips_by(f.trips, "pickup_hour"),
    "profile_by_dow": lambda f: profile.trips_by(f.trips, "day_of_week"),
    "profile_geo": lambda f: profile.profile_geo(f.trips),
    "profile_numeric_stats": lambda f: profile.profile_numeric_stats(f.trips),
    "profile_anomalies": lambda f: profile.profile_anomalies(f.trips),
    "duration_extras": lambda f: profile.duration_extras(f.trips),
    "duration_iqr": lambda f: profile.duration_iqr(f.trips),
    "profile_vendor": lambda f: profile.profile_vendor(f.trips),
    "profile_saf": lambda f: profile.profile_saf(f.trips),
    "profile_quality": lambda f: profile.profile_quality(f.judged, f.settings),
    "profile_component_scores": lambda f: profile.profile_component_scores(f.landed, f.trips),
    "threshold_candidates": lambda f: profile.threshold_candidates(f.trips),
    "profile_schema_full": lambda f: dist.profile_schema_full(f.landed),
    "duplicate_types": lambda f: dist.duplicate_types(f.typed),
    "geo_006": lambda f: dist.extreme_distances(f.judged, f.settings),
    "speed_class": lambda f: dist.speed_classes(f.judged, f.settings, VERY_HIGH_KMH),
    "duration_class": lambda f: dist.duration_classes(f.trips, f.settings),
    "duration_log_stats": lambda f: dist.duration_log_stats(f.trips),
    "duration_histogram": lambda f: dist.duration_histogram(f.trips),
    "duration_boxplot": lambda f: dist.duration_boxplot(f.trips),
    "duration_by_dim": lambda f: dist.duration_by_dim(f.valid),
    "demand_profile": lambda f: dist.demand_profile(f.valid),
    "coord_profile": lambda f: dist.coord_profile(f.trips),
    "cross_field": lambda f: dist.cross_field(f.valid),
    "vendor_profile_full": lambda f: dist.vendor_profile_full(f.valid, f.settings),
    "passenger_profile": lambda f: dist.passenger_profile(f.trips),
    "distance_rates": lambda f: dist.distance_rates(f.trips, f.settings),
    "valid_rate_drift": _valid_rate_drift,
    "star_schema": _star_schema,
    "star_sizes": _star_sizes,
    # checks
    "expect_not_null": _expect_not_null,
    "expect_unique": _expect_unique,
    "expect_accepted": _expect_accepted,
    "assert_duration_positive": lambda f: ex.assert_duration_positive(f.valid),
    "assert_non_negative": lambda f: ex.assert_non_negative(f.valid),
    "assert_has_reason": lambda f: ex.assert_has_reason(f.quarantine),
    "assert_reconciliation": lambda f: ex.assert_reconciliation(f.quality),
    "assert_share_100": lambda f: ex.assert_share_100(f.vendors),
    "assert_outliers_kept": lambda f: ex.assert_outliers_kept(
        f.judged, f.valid, f.settings.require("extreme_duration_seconds")),
}


def _one_batch(f: Frames) -> DataFrame:
    return f.valid.where(F.col("source_hash") == "batch_a")


# The checks that find nothing on a sound build, over rows in which they have to find something.
_QUERIES |= {
    "can_fail_duration": lambda f: ex.assert_duration_positive(f.judged),
    "can_fail_negative": lambda f: ex.assert_non_negative(f.valid.withColumn(
        "estimated_distance_km", -F.col("estimated_distance_km"))),
    "can_fail_reason": lambda f: ex.assert_has_reason(f.judged),
    "can_fail_reconciliation": lambda f: ex.assert_reconciliation(
        marts.data_quality(f.judged, _one_batch(f), f.quarantine)),
    "can_fail_share": lambda f: ex.assert_share_100(f.vendors.where("vendor_id = 1")),
    "can_fail_overlap": lambda f: ex.audit_overlap(f.typed, f.quarantine),
    "profile_tables": lambda f: _profile_tables(f),
}


def _profile_tables(f: Frames) -> DataFrame:
    """The six stored profile tables of two runs: every row carries its run."""
    found = []
    for run_id in ("RUN_1", "RUN_2"):
        store = Store(f.spark, scratch_dir(f.spark, "profile"))
        tables = write_profile(f.landed, f.judged, store, f.settings, run_id, datetime(2024, 1, 2))
        found += [rows.groupBy(F.lit(name).alias("table"), "profiling_run_id").agg(
            F.count("*").alias("rows")) for name, rows in tables.items()]
    return reduce(DataFrame.unionAll, found)


def _query(build: Callable[[Frames], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Frames(spark, sf_dir))


QUERIES: dict[str, Query] = {name: _query(build) for name, build in _QUERIES.items()}
