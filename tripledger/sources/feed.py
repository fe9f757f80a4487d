"""A deterministic trip feed derived row by row from `lineitem`.

One trip per line item, with every kind of defect planted at a known rate. Plain whole-number
arithmetic and one division, so any engine computes the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.sources.contract import SOURCE_COLUMNS

# A row has the defect when its mix number is divisible by the prime.
DEFECT_PRIMES = {
    "missing_id": 997, "missing_vendor": 991, "unknown_vendor": 983,
    "missing_pickup_time": 977, "zero_duration": 971, "negative_duration": 967,
    "origin_pickup": 953, "lower_case_flag": 947, "missing_pickup_lat": 941,
    "same_point": 937, "far_pickup": 929, "dropoff_before": 919, "duration_mismatch": 911,
    "missing_dropoff_time": 907, "zero_passengers": 887, "far_dropoff": 883,
    "missing_flag": 881, "extreme_duration": 499,
    "polar_pickup": 853, "past_date_line": 857,
    "bad_number_text": 877, "bad_time_text": 863, "padded_text": 859,
}


def _hit(defect: str) -> Column:
    return F.col("h") % DEFECT_PRIMES[defect] == 0


def _first_of(default: Column, *branches: tuple[str, object]) -> Column:
    """The value of the first planted defect a row has, else the clean value."""
    value = default
    for defect, planted in reversed(branches):
        value = F.when(_hit(defect), F.lit(planted)).otherwise(value)
    return value


def _coordinate(origin: int, factor: int, span: int) -> Column:
    """Odd micro-degrees, so that rounding to a cell never meets an exact tie."""
    return (F.lit(origin) + (F.col("h") * factor) % span * 2) / F.lit(1_000_000.0)


def _plus(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), ts)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed trips with their batch; column ``h`` is the mix number the defects hang on."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    mix = (F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729
           + F.col("l_linenumber").cast("bigint") * 1299709) % 1000003
    rows = items.withColumn("h", mix.cast("bigint"))
    batch = F.when(F.col("l_orderkey") % 2 == 0, "batch_a").otherwise("batch_b")
    trip_id = F.concat(F.lit("id"), F.col("l_orderkey").cast("string"), F.lit("-"),
                       F.col("l_linenumber").cast("string"), F.lit("-"),
                       (F.col("l_partkey") % 4).cast("string"))
    no_time = F.lit(None).cast("timestamp_ntz")
    rows = rows.select(
        "h",
        "l_linenumber", "l_returnflag",
        _first_of(trip_id, ("missing_id", None)).alias("id"),
        _first_of((1 + F.col("l_suppkey") % 2).cast("int"), ("missing_vendor", None),
                  ("unknown_vendor", 3)).alias("vendor_id"),
        F.when(~_hit("missing_pickup_time"),
               _plus(F.col("l_shipdate"), F.col("h") % 86400)).alias("pickup_datetime"),
        _first_of(60 + (F.col("h") * 31) % 4200, ("zero_duration", 0),
                  ("negative_duration", -45), ("extreme_duration", 90000))
        .cast("bigint").alias("trip_duration"),
        _first_of(_coordinate(40600001, 13, 150000), ("origin_pickup", 0.0),
                  ("missing_pickup_lat", None), ("far_pickup", 42.0), ("polar_pickup", 95.0))
        .alias("pickup_latitude"),
        _first_of(_coordinate(-74049999, 17, 125000), ("origin_pickup", 0.0))
        .alias("pickup_longitude"),
        batch.alias("source_hash"),
        F.concat(batch, F.lit(".csv")).alias("source_file"),
    )
    pickup = F.col("pickup_datetime")
    dropoff = (F.when(_hit("missing_dropoff_time"), no_time)
               .when(_hit("dropoff_before"), _plus(pickup, F.lit(-600)))
               .when(_hit("duration_mismatch"), _plus(pickup, F.col("trip_duration") + 900))
               .otherwise(_plus(pickup, F.col("trip_duration"))))
    flag = (F.when(_hit("missing_flag"), F.lit(None).cast("string"))
            .when(_hit("lower_case_flag"), "y")
            .otherwise(F.when(F.col("l_returnflag") == "R", "Y").otherwise("N")))
    return rows.select(
        "h", "id", "vendor_id", "pickup_datetime",
        dropoff.alias("dropoff_datetime"),
        _first_of(F.col("l_linenumber"), ("zero_passengers", 0)).cast("int")
        .alias("passenger_count"),
        "pickup_longitude", "pickup_latitude",
        F.when(_hit("same_point"), F.col("pickup_longitude"))
        .when(_hit("past_date_line"), -190.0)
        .otherwise(_coordinate(-74049999, 23, 125000)).alias("dropoff_longitude"),
        F.when(_hit("same_point"), F.col("pickup_latitude")).when(_hit("far_dropoff"), 42.0)
        .otherwise(_coordinate(40600001, 19, 150000)).alias("dropoff_latitude"),
        flag.alias("store_and_fwd_flag"),
        "trip_duration", "source_file", "source_hash",
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips as landing text: blank for missing, some cells malformed or padded."""
    rows = trips(spark, sf_dir)
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SOURCE_COLUMNS}
    text["trip_duration"] = F.when(_hit("bad_number_text"), "n/a").otherwise(text["trip_duration"])
    text["dropoff_datetime"] = (F.when(_hit("bad_time_text"), "not a time")
                                .otherwise(text["dropoff_datetime"]))
    text["vendor_id"] = (F.when(_hit("padded_text"), F.concat(F.lit(" "), text["vendor_id"],
                                                              F.lit(" ")))
                         .otherwise(text["vendor_id"]))
    return rows.select(*[text[c].alias(c) for c in SOURCE_COLUMNS], "source_file", "source_hash")
