"""Further profiles: duplicates, classes, distributions and relations between fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.config import Settings
from tripledger.functions.rounding import MICRO, micro, pct, ratio, wide_sum
from tripledger.operators.histogram import (
    as_units, avg_duration, avg_km, avg_kmh, duration_cells, exact_percentiles, n_trips,
    percentile_columns, with_percentiles,
)
from tripledger.operators.moments import correlation
from tripledger.operators.rank_index import RankIndex, interpolated
from tripledger.plans.profile import NANO, nano, value_counts
from tripledger.sources.contract import COLUMNS, SOURCE_COLUMNS
from tripledger.sources.stages import stored


def profile_schema_full(landed: DataFrame) -> DataFrame:
    """Type, nullability, exact distinct count and missing cells per source column.

    Values are counted per (column, value) first, so a frequent value is one row by the time a
    column's distinct values are counted.
    """
    blank_free = value_counts(landed, SOURCE_COLUMNS).withColumn("value", F.nullif(
        F.trim("value"), F.lit("")))
    per_column = (blank_free.groupBy("column_name", "value").agg(F.sum("count").alias("count"))
                  .groupBy("column_name").agg(
        F.count("value").alias("distinct_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0))
        .alias("null_count"),
        F.sum("count").alias("total")))
    kinds = F.create_map(*[F.lit(x) for name, kind, _ in COLUMNS for x in (name, kind)])
    nullable = F.create_map(*[F.lit(x) for name, _, null in COLUMNS for x in (name, null)])
    return per_column.select(
        "column_name", kinds[F.col("column_name")].alias("data_type"),
        nullable[F.col("column_name")].alias("nullable"), "distinct_count", "null_count",
        (F.lit(100.0) * F.col("null_count") / F.col("total")).alias("null_rate"))


def duplicate_types(trips: DataFrame) -> DataFrame:
    """Repeated ids by kind: A the same row again, B the same trip from another batch, C in conflict.

    Copies are counted per (id, content) before they meet their id, so an id with very many
    equal copies is a few rows there.
    """
    payload = [c for c in trips.columns if c not in ("id", "source_file", "source_hash",
                                                     "ingested_at")]
    content = trips.where(F.col("id").isNotNull()).groupBy("id", "source_hash", *payload).agg(
        F.count("*").alias("n"))
    contents = content.groupBy("id", *payload).agg(F.sum("n").alias("n"),
                                                   F.count("*").alias("batches"))
    ids = contents.groupBy("id").agg(F.sum("n").alias("n"), F.count("*").alias("payloads"),
                                     F.max("batches").alias("batches"))
    kind = (F.when(F.col("payloads") > 1, "C").when(F.col("batches") > 1, "B").otherwise("A"))
    total = trips.agg(F.count("*")).scalar()
    return (ids.where("n > 1").groupBy(kind.alias("duplicate_type"))
            .agg(F.count("*").alias("ids"), F.sum("n").alias("rows"))
            .withColumn("rate", pct(F.col("rows"), total)))


def extreme_distances(judged: DataFrame, settings: Settings) -> DataFrame:
    """GEO-006, looked for before the split: valid points are never that far apart."""
    limit = settings.require("extreme_distance_km")
    return judged.where(F.col("estimated_distance_km") > limit).select(
        "id", "source_hash", "estimated_distance_km", "coordinate_anomaly", "is_valid_trip",
        F.lit("GEO-006").alias("distance_anomaly"))


def speed_class(settings: Settings, very_high_kmh: float | None = None) -> Column:
    """Why a speed looks odd; a bad position or duration explains it before the value does.

    There is no approved upper cutoff, so SPEED-003 needs one from the caller.
    """
    duration = F.col("trip_duration")
    extreme = settings.get("extreme_duration_seconds")
    odd_duration = duration.isNull() | (duration <= 0)
    if extreme is not None:
        odd_duration |= duration > extreme
    found = (F.when(F.coalesce(F.col("coordinate_anomaly") != "GEO-005", F.lit(False)), "SPEED-004")
             .when(odd_duration, "SPEED-005")
             .when(F.col("estimated_distance_km") == 0, "SPEED-001"))
    low = settings.get("low_speed_kmh")
    if low is not None:
        found = found.when(F.col("estimated_speed_kmh") < low, "SPEED-002")
    if very_high_kmh is not None:
        found = found.when(F.col("estimated_speed_kmh") > very_high_kmh, "SPEED-003")
    return found.otherwise("NORMAL")


def speed_classes(judged: DataFrame, settings: Settings,
                  very_high_kmh: float | None = None) -> DataFrame:
    return judged.groupBy(speed_class(settings, very_high_kmh).alias("speed_class")).agg(
        F.count("*").alias("trips"), F.count_if(F.col("is_valid_trip")).alias("valid_trips"))


def duration_class(settings: Settings) -> Column:
    duration = F.col("trip_duration")
    return (F.when(duration.isNull() | (duration <= 0), "INVALID")
            .when(duration > settings.require("extreme_duration_seconds"), "EXTREME_REVIEW")
            .when(duration > settings.require("long_trip_seconds"), "LONG_BUT_PLAUSIBLE")
            .otherwise("NORMAL"))


def duration_classes(trips: DataFrame, settings: Settings) -> DataFrame:
    total = trips.agg(F.count("*")).scalar()
    return (trips.groupBy(duration_class(settings).alias("duration_class"))
            .agg(F.count("*").alias("trips"))
            .withColumn("percentage", F.lit(100.0) * F.col("trips") / total))


def _counted_durations(trips: DataFrame) -> DataFrame:
    return (trips.where(F.col("trip_duration") > 0).groupBy("trip_duration")
            .agg(F.count("*").alias("n")))


def duration_log_stats(trips: DataFrame) -> DataFrame:
    """log(1 + duration) of positive durations, from one row per distinct duration."""
    counted = stored(_counted_durations(trips), "durations").withColumn("x", F.log1p(F.col("trip_duration").cast("double")))
    n = F.sum("n")
    mean = F.sum(F.col("x") * F.col("n")) / n
    square = F.sum(F.col("x") * F.col("x") * F.col("n"))
    points = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    stats = counted.agg(
        n.alias("n"), F.round(F.min("x"), 6).alias("min"), F.round(F.max("x"), 6).alias("max"),
        F.round(mean, 6).alias("mean"),
        F.round(F.sqrt((square - mean * mean * n) / (n - 1)), 6).alias("stddev"))
    # The logarithm keeps the order, so the ranks are those of the durations.
    low, high = (F.log1p(F.col(c).cast("double")) for c in ("low", "high"))
    found = exact_percentiles(
        counted.select(F.lit("x").alias("name"), F.col("trip_duration").alias("v"), "n"), points)
    at = found.select("label", F.round(interpolated(low, high, F.col("weight")), 6).alias("x"))
    row = at.agg(*[F.max(F.when(F.col("label") == p, F.col("x"))).alias(p) for p in points])
    return stats.select("*", row.select(F.struct("*")).scalar().alias("p")).select(
        "n", "min", "max", "mean", "stddev", "p.*")


def duration_histogram(trips: DataFrame, width: int = 300) -> DataFrame:
    """Trips per duration bin; the bin is named by its first second, if 64 bits hold that."""
    start = F.try_multiply(F.floor(F.col("trip_duration") / width).cast("bigint"), F.lit(width))
    return (trips.where(F.col("trip_duration").isNotNull()).groupBy(start.alias("bin_start"))
            .agg(F.count("*").alias("trips")))


def duration_boxplot(trips: DataFrame) -> DataFrame:
    """Quartiles, whiskers inside 1.5 quartile distances, and the rows beyond them."""
    counted = stored(_counted_durations(trips), "durations")
    box = RankIndex(counted, [], "trip_duration").percentiles(
        {"q1": 0.25, "median": 0.5, "q3": 0.75}, places=9)
    boxed = counted.withColumn("p", box.select(F.array("q1", "median", "q3")).scalar())
    reach = (F.col("p")[2] - F.col("p")[0]) * 1.5
    inside = F.col("trip_duration").between(F.col("p")[0] - reach, F.col("p")[2] + reach)
    return boxed.agg(
        F.max("p").alias("p"),
        F.min(F.when(inside, F.col("trip_duration"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("trip_duration"))).alias("upper_whisker"),
        F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers"),
    ).select("lower_whisker", F.round(F.col("p")[0], 4).alias("q1"),
             F.round(F.col("p")[1], 4).alias("median"), F.round(F.col("p")[2], 4).alias("q3"),
             "upper_whisker", "outliers")


def _dimension_values(columns: dict[str, Column]) -> Column:
    return F.inline(F.array(*[F.struct(F.lit(name).alias("dimension"),
                                       c.cast("string").alias("value"))
                              for name, c in columns.items()]))


def _weekday_name(number: Column) -> Column:
    """Day name of Spark's weekday number, 1 for Sunday."""
    return F.date_format(F.date_add(F.lit("2023-12-31").cast("date"), number - 1), "EEEE")


def duration_by_dim(trips: DataFrame) -> DataFrame:
    """Duration by hour, weekday, part of day and vendor, from one grouping of the rows."""
    days = trips.withColumn("weekday", F.dayofweek("pickup_date"))
    cells = duration_cells(days, ["pickup_hour", "weekday", "vendor_id", "time_of_day"])
    by_dim = cells.select("trip_duration", "n", _dimension_values({
        "hour": F.col("pickup_hour"), "weekday": _weekday_name(F.col("weekday")),
        "time_of_day": F.col("time_of_day"), "vendor": F.col("vendor_id")}))
    keys = ["dimension", "value"]
    counted = stored(by_dim.groupBy(*keys, "trip_duration").agg(F.sum("n").alias("n")),
                     "duration-cells")
    grouped = counted.groupBy(*keys).agg(
        n_trips().alias("trips"), avg_duration(4).alias("avg_duration_seconds"))
    points = {"p50": 0.5, "p90": 0.9, "p95": 0.95}
    return with_percentiles(grouped, counted, points, keys).select(
        *keys, "trips", "avg_duration_seconds",
        *[F.round(label, 4).alias(f"{label}_duration_seconds") for label in points])


def demand_profile(valid: DataFrame) -> DataFrame:
    """Trips per date, hour, weekday, month, part of day and weekend flag, extremes marked.

    Trips are counted per date and hour first; among equal extremes the smallest value counts.
    """
    hours = valid.groupBy("pickup_date", "pickup_hour", "time_of_day").agg(
        F.count("id").alias("n"))
    date = F.col("pickup_date")
    weekend = F.when(F.dayofweek(date).isin(1, 7), "weekend").otherwise("weekday")
    demand = hours.select("n", _dimension_values({
        "date": date, "hour": F.lpad(F.col("pickup_hour").cast("string"), 2, "0"),
        "weekday": F.date_format(date, "EEEE"),
        "month": F.date_format(date, "yyyy-MM"), "time_of_day": F.col("time_of_day"),
        "weekend": weekend}))
    totals = demand.groupBy("dimension", "value").agg(F.sum("n").alias("trips"))
    group = Window.partitionBy("dimension")
    most = F.min(F.struct((-F.col("trips")).alias("n"), "value")).over(group)
    least = F.min(F.struct(F.col("trips").alias("n"), "value")).over(group)
    return totals.select("dimension", "value", "trips",
                         (most["value"] == F.col("value")).alias("is_max"),
                         (least["value"] == F.col("value")).alias("is_min"))


COORDINATES = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


def coord_profile(trips: DataFrame) -> DataFrame:
    """Missing, extremes, percentiles, distinct values and the most common value per coordinate."""
    pairs = F.array(*[F.struct(F.lit(c).alias("coordinate"), F.col(c).alias("value"))
                      for c in COORDINATES])
    counted = (trips.select(F.inline(pairs)).groupBy("coordinate", "value")
               .agg(F.count("*").alias("n")))
    known = F.col("value").isNotNull()
    base = counted.groupBy("coordinate").agg(
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_count"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.count("value").alias("distinct_count"),
        F.max(F.when(known, F.col("n"))).alias("common_count"))
    # The largest count first, then the smallest value that has it.
    common = (counted.join(base.select("coordinate", F.col("common_count").alias("n")),
                           ["coordinate", "n"])
              .groupBy("coordinate").agg(F.min("value").alias("common_value")))
    points = {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    found = percentile_columns(exact_percentiles(
        as_units(trips, {c: nano(F.col(c)) for c in COORDINATES}), points), list(points), NANO)
    return (base.join(found.withColumnRenamed("name", "coordinate"), "coordinate", "left")
            .join(common, "coordinate", "left").select(
                "coordinate", "null_count", "min", *points, "max", "distinct_count",
                "common_value", "common_count"))


def cross_field(valid: DataFrame) -> DataFrame:
    """Correlation of distance and duration, and trips where the two contradict each other.

    "Short" and "long" are the 5th and 95th percentiles of the same trips.
    """
    found = percentile_columns(exact_percentiles(as_units(valid, {
        "duration": F.col("trip_duration"),
        "distance": micro(F.col("estimated_distance_km"))}),
        {"p5": 0.05, "p95": 0.95}), ["p5", "p95"])
    unit = {"distance": float(MICRO), "duration": 1.0}
    limits = found.agg(*[F.max(F.when(F.col("name") == n, F.round(F.col(p) / unit[n], 9)))
                         .alias(f"{n}_{p}") for n in ("distance", "duration") for p in ("p5", "p95")])
    rows = valid.select("estimated_distance_km", "trip_duration",
                        limits.select(F.struct("*")).scalar().alias("l"))
    km, seconds = F.col("estimated_distance_km"), F.col("trip_duration")
    return rows.agg(
        F.count("*").alias("trips"),
        F.round(correlation(micro(km), seconds), 6).alias("correlation"),
        F.max("l").alias("l"),
        F.count_if((km <= F.col("l.distance_p5")) & (seconds >= F.col("l.duration_p95")))
        .alias("short_distance_long_duration"),
        F.count_if((km >= F.col("l.distance_p95")) & (seconds <= F.col("l.duration_p5")))
        .alias("long_distance_short_duration"),
    ).select("trips", "correlation", "l.*", "short_distance_long_duration",
             "long_distance_short_duration")


def vendor_profile_full(valid: DataFrame, settings: Settings) -> DataFrame:
    long_limit = settings.require("long_trip_seconds")
    counted = stored(duration_cells(valid, ["vendor_id"]), "duration-cells")
    cells = counted.groupBy("vendor_id").agg(
        n_trips().alias("trip_count"), avg_duration(4).alias("avg_duration"),
        avg_km().alias("avg_distance"), avg_kmh().alias("avg_speed"),
        F.sum(F.when(F.col("trip_duration") > long_limit, F.col("n")).otherwise(0)).alias("n_long"))
    distances = stored(valid.groupBy("vendor_id", micro(F.col("estimated_distance_km")).alias("v"))
                       .agg(F.count("*").alias("n")), "distance-cells")
    total = cells.agg(F.sum("trip_count")).scalar()
    points = {"median_duration": 0.5, "p90_duration": 0.9, "p95_duration": 0.95}
    median = F.round(F.col("median_distance") / F.lit(float(MICRO)), 9)
    both = RankIndex(distances, ["vendor_id"]).added_to(
        with_percentiles(cells, counted, points, "vendor_id"), {"median_distance": 0.5})
    return (both.withColumns({"trip_share": pct(F.col("trip_count"), total), "median_distance": median})
            .select("vendor_id", "trip_count", "trip_share", "avg_duration",
                    *[F.round(label, 4).alias(label) for label in points],
                    "avg_distance", "median_distance", "avg_speed",
                    pct(F.col("n_long"), F.col("trip_count")).alias("long_trip_rate")))


def passenger_profile(trips: DataFrame) -> DataFrame:
    counted = stored(trips.groupBy("passenger_count").agg(F.count("*").alias("n")), "seats")
    median = RankIndex(counted, [], "passenger_count").percentiles({"median": 0.5})
    seats = F.col("passenger_count")
    zero = F.lit(0).cast("bigint")
    return counted.agg(
        F.min(seats).alias("min"), F.max(seats).alias("max"),
        ratio(wide_sum(seats.cast("bigint") * F.col("n")),
              F.sum(F.when(seats.isNotNull(), F.col("n"))), 6).alias("mean"),
        F.lit(0).alias("median"),
        F.count(seats).alias("distinct_count"),
        F.coalesce(F.sum(F.when(seats == 0, F.col("n"))), zero).alias("zero_count"),
        F.coalesce(F.sum(F.when(seats < 0, F.col("n"))), zero).alias("negative_count"),
        F.coalesce(F.sum(F.when(seats.isNull(), F.col("n"))), zero).alias("null_count")
    ).withColumn("median", F.round(median.scalar(), 4))


def distance_rates(trips: DataFrame, settings: Settings) -> DataFrame:
    km = F.col("estimated_distance_km")
    counted = trips.agg(F.count(km).alias("with_distance"), F.count_if(km == 0).alias("zero_distance"),
                        F.count_if(km > settings.require("extreme_distance_km"))
                        .alias("extreme_distance"))
    return counted.select(
        "*", pct(F.col("zero_distance"), F.col("with_distance")).alias("zero_distance_rate"),
        pct(F.col("extreme_distance"), F.col("with_distance")).alias("extreme_distance_rate"))


def valid_rate_drift(runs: DataFrame) -> DataFrame:
    """Change of the valid rate of the same file between consecutive runs.

    ``runs`` has run_number, source_hash, total_records and valid_records. The input is the same
    by its hash, so a change comes from the code or the settings.
    """
    order = Window.partitionBy("source_hash").orderBy("run_number")
    rate = pct(F.col("valid_records"), F.col("total_records"))
    return (runs.withColumn("valid_rate_pct", rate)
            .withColumn("previous_valid_records", F.lag("valid_records").over(order))
            .withColumn("valid_records_change",
                        F.col("valid_records") - F.col("previous_valid_records"))
            .withColumn("drifted", F.coalesce(F.col("valid_records_change") != 0, F.lit(False))))
