"""Profiling: measure raw and typed trips. It classifies and counts; it never removes a row.

``landed`` is the text of the files, ``trips`` the typed and derived rows, ``judged`` the same
rows with their rule outcomes.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.config import Settings
from tripledger.functions.rounding import MICRO, micro, pct, ratio, wide_sum
from tripledger.operators.histogram import (
    as_units, avg_duration, avg_km, avg_kmh, cell_percentiles, duration_cells, exact_percentiles,
    interpolated, n_trips, percentile_columns, with_percentiles,
)
from tripledger.operators.moments import deviation
from tripledger.operators.rules import (
    CHECKED, COMPONENTS, FAILED, FLAGGING, RULES, Rule, any_of, failures_of,
)
from tripledger.sources.contract import SOURCE_COLUMNS
from tripledger.sources.stages import stored

# Percentile labels and points of the numeric profile.
POINTS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9,
          "p95": 0.95, "p99": 0.99, "p995": 0.995, "p999": 0.999}
DOMAIN_COLUMNS = ("vendor_id", "store_and_fwd_flag", "passenger_count")


def _long(row: DataFrame, entries: list[Column]) -> DataFrame:
    """Turn one wide row into one row per struct."""
    return row.select(F.inline(F.array(*entries)))


def _share(count: Column, total: Column) -> Column:
    return F.lit(100.0) * count / total


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(F.col(name)) == "")


def profile_run(landed: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """What was profiled. The load id belongs to the landing folder, not to the trips."""
    columns = [c for c in landed.columns if c != "load_id"]
    return landed.agg(
        F.lit(run_id).alias("profiling_run_id"),
        F.lit(at).cast("timestamp_ntz").alias("profiling_timestamp"),
        F.min("source_file").alias("source_file"),
        F.min("source_hash").alias("source_hash"),
        F.count("*").alias("row_count"),
        F.lit(len(columns)).alias("column_count"),
        F.countDistinct("source_hash").alias("batches"),
        F.lit("PASS" if len(columns) >= len(SOURCE_COLUMNS) else "FAIL")
        .alias("profile_status"),
    )


def profile_schema(landed: DataFrame) -> DataFrame:
    """Missing or blank cells per source column, all columns in one pass."""
    counts = landed.agg(F.count("*").alias("total"),
                        *[F.count_if(_blank(c)).alias(c) for c in SOURCE_COLUMNS])
    return _long(counts, [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"),
                 _share(F.col(c), F.col("total")).alias("null_rate"),
                 F.when(F.col(c) == 0, "PASS").otherwise("INVESTIGATE").alias("status"))
        for c in SOURCE_COLUMNS])


def exact_duplicates(landed: DataFrame) -> DataFrame:
    """Rows that have at least one identical copy in every source column.

    The grouping compares whole rows, not a hash of them; copies collapse map-side.
    """
    copies = landed.groupBy(*SOURCE_COLUMNS).agg(F.count("*").alias("n")).where("n > 1")
    zero = F.lit(0).cast("bigint")
    return copies.agg(F.count("*").alias("duplicated_payloads"),
                      F.coalesce(F.sum("n"), zero).alias("exact_duplicate_rows"))


def profile_uniqueness(landed: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    ids = (landed.where(~_blank("id")).groupBy("id").agg(F.count("*").alias("n"))
           .agg(F.count("*").alias("distinct_ids"), F.count_if(F.col("n") > 1).alias("duplicated_ids"),
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), zero)
                .alias("duplicate_rows")))
    exact = exact_duplicates(landed).select("exact_duplicate_rows").scalar()
    total = landed.agg(F.count("*")).scalar()
    return ids.select("distinct_ids", "duplicated_ids", "duplicate_rows",
                      exact.alias("exact_duplicate_rows"),
                      pct(F.col("duplicate_rows"), total).alias("duplicate_rate"))


def value_counts(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(column_name, value, count) of several columns in one scan, missing values included."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (rows.select(F.inline(pairs)).groupBy("column_name", "value")
            .agg(F.count("*").alias("count")))


def profile_domain_stats(landed: DataFrame, limit: int = 25) -> DataFrame:
    """The most frequent values; equal counts are ordered by value."""
    order = Window.partitionBy("column_name").orderBy(F.col("count").desc(), "value")
    total = landed.agg(F.count("*")).scalar()
    best = (value_counts(landed, DOMAIN_COLUMNS).withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= limit).drop("place"))
    return best.withColumn("percentage", _share(F.col("count"), total))


def duration_consistency_stats(trips: DataFrame) -> DataFrame:
    """How far the recorded duration is from the two time stamps."""
    diff = F.col("duration_difference_seconds")
    by_value = stored(trips.groupBy("duration_difference_seconds").agg(F.count("*").alias("n")),
                      "differences")
    known = F.sum(F.when(diff.isNotNull(), F.col("n")))
    spread = by_value.agg(
        F.coalesce(F.sum(F.when(diff == 0, F.col("n"))), F.lit(0)).alias("exact_match"),
        F.coalesce(F.sum(F.when(diff != 0, F.col("n"))), F.lit(0)).alias("mismatch"),
        F.min(diff).alias("min_diff"), F.max(diff).alias("max_diff"),
        ratio(F.sum(diff.cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")), known, 4)
        .alias("mean_diff"))
    middle = cell_percentiles(by_value, {"median_diff": 0.5}, value="duration_difference_seconds")
    spread = spread.select("*", F.round(middle.scalar(), 4).alias("median_diff"))
    dates = (trips.groupBy("pickup_date").agg(F.count("*").alias("n"))
             .agg(F.min("pickup_date").alias("min_date"), F.max("pickup_date").alias("max_date"),
                  F.count("pickup_date").alias("dates")))
    both = trips.sparkSession.range(1).select(dates.select(F.struct("*")).scalar().alias("d"),
                                              spread.select(F.struct("*")).scalar().alias("s"))
    return both.select("d.*", "s.*")


def trips_by(trips: DataFrame, column: str) -> DataFrame:
    """Row counts per value; the bucket without a value is kept."""
    return trips.groupBy(column).agg(F.count("*").alias("trips"))


def geo_counts() -> dict[str, Column]:
    """Independent counts of coordinate problems; unlike the class, one row can be in several."""
    ends = ("pickup", "dropoff")
    lats = [F.col(f"{e}_latitude") for e in ends]
    lons = [F.col(f"{e}_longitude") for e in ends]
    return {
        "geo_001": F.count_if(any_of(c.isNull() for c in lats + lons)),
        "geo_002": F.count_if(any_of(F.abs(c) > 90 for c in lats)),
        "geo_003": F.count_if(any_of(F.abs(c) > 180 for c in lons)),
        "geo_at_origin": F.count_if((lats[0] == 0) & (lons[0] == 0)),
        "geo_005": F.count_if((lats[0] == lats[1]) & (lons[0] == lons[1])),
    }


# Coordinates are located in billionths of a degree, a tenth of a millimetre on the ground.
NANO = 1_000_000_000


def nano(degrees: Column) -> Column:
    return F.rint(degrees * F.lit(float(NANO))).try_cast("bigint")


def profile_geo(trips: DataFrame) -> DataFrame:
    lat, lon = F.col("pickup_latitude"), F.col("pickup_longitude")
    counted = trips.agg(
        F.min(lat).alias("plat_min"), F.max(lat).alias("plat_max"),
        F.min(lon).alias("plon_min"), F.max(lon).alias("plon_max"),
        *[c.alias(name) for name, c in geo_counts().items()])
    found = percentile_columns(
        exact_percentiles(as_units(trips, {"plat": nano(lat), "plon": nano(lon)}),
                          {"p1": 0.01, "p99": 0.99}), ["p1", "p99"], NANO)
    limits = found.agg(*[F.max(F.when(F.col("name") == n, F.col(p))).alias(f"{n}_{p}")
                         for n in ("plat", "plon") for p in ("p1", "p99")])
    both = trips.sparkSession.range(1).select(counted.select(F.struct("*")).scalar().alias("c"),
                                              limits.select(F.struct("*")).scalar().alias("l"))
    return both.select("c.*", "l.*")


# Profiled measure, its column and how many whole units make one.
MEASURES = (("duration", "trip_duration", 1),
            ("distance", "estimated_distance_km", MICRO),
            ("speed", "estimated_speed_kmh", MICRO))


def _units(column: str, scale: int) -> Column:
    return F.col(column) if scale == 1 else micro(F.col(column))


def measure_percentiles(trips: DataFrame, points: Mapping[str, float] = POINTS) -> DataFrame:
    """One row per measure with a column per point, in the measure's own unit."""
    found = exact_percentiles(
        as_units(trips, {name: _units(c, scale) for name, c, scale in MEASURES}), points)
    scale = F.when(F.col("name") == "duration", 1.0).otherwise(float(MICRO))
    value = F.round(interpolated(F.col("low").cast("double"), F.col("high").cast("double"),
                                 F.col("weight")) / scale, 9)
    return found.groupBy(F.col("name").alias("column_name")).agg(
        *[F.max(F.when(F.col("label") == label, value)).alias(label) for label in points])


def profile_numeric_stats(trips: DataFrame) -> DataFrame:
    """Count, extremes, mean, sample deviation and percentiles of the three measures."""
    wide = trips.agg(*[
        F.struct(
            F.count(c).alias("n"), F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
            ratio(wide_sum(_units(c, scale)), F.count(c) * scale, 6).alias("mean"),
            F.round(deviation(_units(c, scale), scale), 6).alias("stddev")).alias(name)
        for name, c, scale in MEASURES])
    moments = _long(wide, [
        F.struct(F.lit(name).alias("column_name"),
                 *[F.col(f"{name}.{f}").alias(f) for f in ("n", "min", "max", "mean", "stddev")])
        for name, _, _ in MEASURES])
    return moments.join(measure_percentiles(trips), "column_name", "left")


# Anomaly classes. Severity and action follow the rule that covers the class.
ANOMALIES = (
    ("GEO-001", "geo_001", "high", "QUARANTINE"),
    ("GEO-002", "geo_002", "high", "QUARANTINE"),
    ("GEO-003", "geo_003", "high", "QUARANTINE"),
    ("GEO-005", "geo_005", "medium", "KEEP_AND_REVIEW"),
    ("ZERO_DURATION", "zero_duration", "critical", "QUARANTINE"),
    ("NEGATIVE_DURATION", "negative_duration", "critical", "QUARANTINE"),
    ("ZERO_DISTANCE", "zero_distance", "medium", "KEEP_AND_REVIEW"),
)


def profile_anomalies(trips: DataFrame) -> DataFrame:
    duration = F.col("trip_duration")
    counts = trips.agg(
        F.count("*").alias("total"),
        *[c.alias(name) for name, c in geo_counts().items()],
        F.count_if(duration == 0).alias("zero_duration"),
        F.count_if(duration < 0).alias("negative_duration"),
        F.count_if(F.col("estimated_distance_km") == 0).alias("zero_distance"))
    return _long(counts, [
        F.struct(F.lit(kind).alias("anomaly_type"), F.col(c).alias("record_count"),
                 _share(F.col(c), F.col("total")).alias("percentage"),
                 F.lit(severity).alias("severity"), F.lit(action).alias("recommended_action"))
        for kind, c, severity, action in ANOMALIES])


def duration_extras(trips: DataFrame) -> DataFrame:
    duration = F.col("trip_duration")
    return trips.agg(F.count_if(duration == 0).alias("zero"),
                     F.count_if(duration < 0).alias("negative"),
                     F.count_if(duration.isNull()).alias("null_count"),
                     F.count_if(F.col("estimated_distance_km") == 0).alias("zero_distance"))


def duration_iqr(trips: DataFrame) -> DataFrame:
    """Quartile distance of the duration and the upper bound it suggests."""
    counted = trips.groupBy("trip_duration").agg(F.count("*").alias("n"))
    found = cell_percentiles(counted, {"p25": 0.25, "p75": 0.75})
    quartiles = trips.sparkSession.range(1).select(found.select(F.struct("*")).scalar().alias("p"))
    low, high = F.col("p.p25"), F.col("p.p75")
    return quartiles.select(F.round(low, 4).alias("p25"), F.round(high, 4).alias("p75"),
                            F.round(high - low, 4).alias("iqr"),
                            F.round(high + (high - low) * 1.5, 4).alias("upper"))


def _by_group(trips: DataFrame, key: str, points: Mapping[str, float], *extra: Column) -> DataFrame:
    cells = stored(duration_cells(trips, [key]), "duration-cells")
    grouped = cells.groupBy(key).agg(n_trips().alias("n"), avg_duration(4).alias("avg_dur"), *extra)
    rest = grouped.columns[3:]
    found = [F.round(label, 4).alias(label) for label in points]
    return with_percentiles(grouped, cells, points, key).select(key, "n", "avg_dur", *found, *rest)


def profile_vendor(trips: DataFrame) -> DataFrame:
    return _by_group(trips, "vendor_id", {"p50": 0.5, "p90": 0.9, "p95": 0.95},
                     avg_km().alias("avg_dist"), avg_kmh().alias("avg_speed"))


def profile_saf(trips: DataFrame) -> DataFrame:
    """By normalised store-and-forward flag."""
    by_flag = _by_group(trips.withColumnRenamed("store_and_fwd_flag_raw", "flag"), "flag",
                        {"p50": 0.5, "p90": 0.9})
    total = trips.agg(F.count("*")).scalar()
    return by_flag.withColumn("percentage", _share(F.col("n"), total))


def _failures(judged: DataFrame, named: dict[str, Rule]) -> DataFrame:
    """One row: ``total`` and the failed rows of each rule. Rows are counted by their failed rules first,
    so the bits are looked at once per combination."""
    combinations = judged.groupBy(FAILED).agg(F.count("*").alias("n"))
    none = F.lit(0).cast("bigint")
    return combinations.agg(
        F.coalesce(F.sum("n"), none).alias("total"),
        *[F.coalesce(F.sum(failures_of(r) * F.col("n")), none).alias(name)
          for name, r in named.items()])


def rule_counts(judged: DataFrame) -> DataFrame:
    """Passed and failed rows per rule, each rule on its own, in one pass."""
    counts = _failures(judged, {r.rule_id: r for r in CHECKED})
    return _long(counts, [
        F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.action).alias("action"),
                 (F.col("total") - F.col(f"`{r.rule_id}`")).alias("passed"),
                 F.col(f"`{r.rule_id}`").alias("failed"))
        for r in RULES if r.predicate])


def profile_quality(judged: DataFrame, settings: Settings) -> DataFrame:
    """Failures per rule. A rule whose parameter is missing is reported as blocked."""
    counts = _failures(judged, {r.column: r for r in CHECKED})
    unknown, no_rate = F.lit(None).cast("bigint"), F.lit(None).cast("double")

    def entry(rule) -> Column:
        if rule.action == "policy":
            failed, status = unknown, F.lit("POLICY")
        elif rule.parameter and not settings.approved(rule.parameter):
            failed, status = unknown, F.lit("BLOCKED_PENDING_THRESHOLD")
        else:
            failed = F.col(rule.column)
            status = F.when(failed == 0, "PASS").otherwise("FAIL")
        rate = _share(failed, F.col("total")) if failed is not unknown else no_rate
        return F.struct(F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.name).alias("rule_name"),
                        F.col("total").alias("total_records"), failed.alias("failed_records"),
                        rate.alias("failure_rate"), status.alias("status"))

    return _long(counts, [entry(r) for r in RULES])


def flag_counts(judged: DataFrame) -> DataFrame:
    """Valid rows that carry each flag."""
    return judged.where("is_valid_trip").agg(
        F.count("*").alias("valid_rows"),
        *[F.count_if(F.col(r.outcome)).alias(r.outcome) for r in FLAGGING])


def profile_component_scores(landed: DataFrame, trips: DataFrame) -> DataFrame:
    """Report scores; consistency here means recorded and observed duration agree."""
    required = ("id", "pickup_datetime", "dropoff_datetime")
    missing = landed.agg(
        F.count("*").alias("total"),
        sum((F.count_if(_blank(c)) for c in required), start=F.lit(0)).alias("blanks"))
    typed = trips.agg(
        F.count_if(F.col("duration_difference_seconds") != 0).alias("mismatch"),
        geo_counts()["geo_001"].alias("no_point"), geo_counts()["geo_at_origin"].alias("origin"))
    duplicates = profile_uniqueness(landed).select("duplicate_rows").scalar()
    total = F.col("m.total")
    both = landed.sparkSession.range(1).select(
        missing.select(F.struct("*")).scalar().alias("m"),
        typed.select(F.struct("*")).scalar().alias("t"), duplicates.alias("d"))
    return both.select(
        pct(F.greatest(total - F.col("m.blanks"), F.lit(0)), total).alias("completeness"),
        pct(total - F.col("d"), total).alias("uniqueness"),
        pct(total - F.col("t.mismatch"), total).alias("consistency"),
        pct(total - F.col("t.no_point") - F.col("t.origin"), total).alias("geographic_validity"))


# Threshold, what waits for it, candidate, how it was found, side that is marked.
CANDIDATES = (
    ("long_trip_seconds", "KPI-016", "A", "percentile P95", "duration", "above"),
    ("long_trip_seconds", "KPI-016", "B", "percentile P99", "duration", "above"),
    ("long_trip_seconds", "KPI-016", "C", "business", "duration", "above"),
    ("low_speed_kmh", "KPI-017", "A", "percentile P25", "speed", "below"),
    ("low_speed_kmh", "KPI-017", "B", "quarter of median", "speed", "below"),
    ("low_speed_kmh", "KPI-017", "C", "business", "speed", "below"),
    ("extreme_duration_seconds", "is_duration_outlier", "A", "percentile P99.9", "duration", "above"),
    ("extreme_duration_seconds", "is_duration_outlier", "B", "IQR", "duration", "above"),
    ("extreme_duration_seconds", "is_duration_outlier", "C", "business", "duration", "above"),
    ("extreme_distance_km", "GEO-006", "A", "percentile P99.9", "distance", "above"),
    ("extreme_distance_km", "GEO-006", "B", "business", "distance", "above"),
)
BUSINESS = {"long_trip_seconds": 3600.0, "low_speed_kmh": 5.0,
            "extreme_duration_seconds": 86400.0, "extreme_distance_km": 100.0}


def threshold_candidates(trips: DataFrame) -> DataFrame:
    """Candidate cutoffs with the rows each would mark, counted rather than assumed.

    Nothing is approved here. The eleven values reach the rows as one scalar subquery.
    """
    stats = measure_percentiles(trips)

    def point(measure: str, label: str) -> Column:
        return F.max(F.when(F.col("column_name") == measure, F.col(label)))

    def value(threshold: str, method: str, measure: str) -> Column:
        if method == "business":
            return F.lit(BUSINESS[threshold])
        if method == "quarter of median":
            return F.round(point(measure, "p50") * 0.25, 9)
        if method == "IQR":
            low, high = point(measure, "p25"), point(measure, "p75")
            return F.round(high + (high - low) * 1.5, 9)
        return point(measure, "p" + method.split("P")[-1].replace(".", ""))

    names = [f"{t}_{letter}" for t, _, letter, _, _, _ in CANDIDATES]
    values = stats.agg(*[value(t, method, measure).alias(n)
                         for n, (t, _, _, method, measure, _) in zip(names, CANDIDATES)])
    column = {name: c for name, c, _ in MEASURES}
    marked = trips.select(*column.values(), values.select(F.struct("*")).scalar().alias("v"))
    counts = marked.agg(
        F.count("*").alias("total"), F.max("v").alias("v"),
        *[F.count_if(F.col(column[measure]) > F.col(f"v.{n}") if side == "above"
                     else F.col(column[measure]) < F.col(f"v.{n}")).alias(n)
          for n, (_, _, _, _, measure, side) in zip(names, CANDIDATES)])
    return _long(counts, [
        F.struct(F.lit(t).alias("threshold"), F.lit(blocks).alias("blocks"),
                 F.lit(letter).alias("candidate"), F.lit(method).alias("method"),
                 F.col(f"v.{n}").alias("value"), F.col(n).alias("flagged_rows"),
                 _share(F.col(n), F.col("total")).alias("flagged_pct"))
        for n, (t, blocks, letter, method, _, _) in zip(names, CANDIDATES)])


def component_scores(quality: DataFrame) -> DataFrame:
    return quality.select("source_hash", *[f"{c}_score_pct" for c in COMPONENTS])
