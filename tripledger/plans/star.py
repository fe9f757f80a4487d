"""Star schema over valid trips: one fact row per trip and five dimensions with whole-number keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.functions.calendar import is_weekend, time_of_day
from tripledger.functions.geo import route
from tripledger.functions.rounding import wide_sum

_LON_CELLS = 36001  # cells of 0.01 degree from -180 to 180
_ROUTE_BASE = 10**9
# Columns of valid trips that the star is made of.
SOURCE = ("id", "pickup_date", "pickup_hour", "vendor_id", "pickup_latitude", "pickup_longitude",
          "dropoff_latitude", "dropoff_longitude", "trip_duration", "estimated_distance_km",
          "estimated_speed_kmh", "is_duration_outlier", "is_speed_outlier")


def location_key(lat: Column, lon: Column) -> Column:
    """Number of the coordinate cell; two cells never share one."""
    row = F.rint((F.round(lat, 2) + 90) * 100).cast("bigint")
    column = F.rint((F.round(lon, 2) + 180) * 100).cast("bigint")
    return row * _LON_CELLS + column


def date_key(date: Column) -> Column:
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def fact_trip(valid: DataFrame) -> DataFrame:
    pickup = location_key(F.col("pickup_latitude"), F.col("pickup_longitude"))
    dropoff = location_key(F.col("dropoff_latitude"), F.col("dropoff_longitude"))
    return valid.select(
        "id", date_key(F.col("pickup_date")).alias("date_key"),
        F.col("pickup_hour").alias("time_key"), F.col("vendor_id").alias("vendor_key"),
        pickup.alias("pickup_location_key"), dropoff.alias("dropoff_location_key"),
        (pickup * _ROUTE_BASE + dropoff).alias("route_key"),
        "trip_duration", "estimated_distance_km", "estimated_speed_kmh",
        "is_duration_outlier", "is_speed_outlier")


def dim_date(valid: DataFrame) -> DataFrame:
    day = F.col("pickup_date")
    return valid.select(day).distinct().select(
        date_key(day).alias("date_key"), day.alias("date"), F.year(day).alias("year"),
        F.month(day).alias("month"), F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day"), F.date_format(day, "EEEE").alias("day_of_week"),
        is_weekend(day).alias("is_weekend"))


def dim_time(valid: DataFrame) -> DataFrame:
    hour = F.col("pickup_hour")
    any_day = F.timestamp_add("HOUR", hour, F.lit("2016-01-01 00:00:00").cast("timestamp_ntz"))
    return valid.select(hour).distinct().select(
        hour.alias("time_key"), hour.alias("hour"), time_of_day(any_day).alias("time_of_day"))


def dim_vendor(valid: DataFrame) -> DataFrame:
    return valid.select(F.col("vendor_id").alias("vendor_key")).distinct().withColumn(
        "vendor_id", F.col("vendor_key"))


def dim_location(valid: DataFrame) -> DataFrame:
    """Every cell in which a trip starts or ends."""
    ends = F.array(*[
        F.struct(location_key(F.col(f"{e}_latitude"), F.col(f"{e}_longitude")).alias("location_key"),
                 F.round(f"{e}_latitude", 2).alias("latitude"),
                 F.round(f"{e}_longitude", 2).alias("longitude"))
        for e in ("pickup", "dropoff")])
    cells = valid.select(F.inline(ends)).distinct()
    return cells.withColumn("area", F.concat(F.col("latitude").cast("string"), F.lit(","),
                                             F.col("longitude").cast("string")))


def dim_route(fact: DataFrame, locations: DataFrame) -> DataFrame:
    pairs = fact.select("route_key", "pickup_location_key", "dropoff_location_key").distinct()
    start = locations.select(F.col("location_key").alias("pickup_location_key"),
                             F.col("area").alias("pickup_area"))
    end = locations.select(F.col("location_key").alias("dropoff_location_key"),
                           F.col("area").alias("dropoff_area"))
    return (pairs.join(start, "pickup_location_key").join(end, "dropoff_location_key")
            .select("route_key", "pickup_location_key", "dropoff_location_key",
                    route(F.col("pickup_area"), F.col("dropoff_area")).alias("route")))


def trips_by_month_and_area(fact: DataFrame, dates: DataFrame, times: DataFrame,
                            locations: DataFrame) -> DataFrame:
    """A join back through the keys.

    Trips are counted per key first, so the dimensions meet a few rows per key, not every trip.
    Seconds are summed as decimals; a sum that no 64-bit number holds is missing.
    """
    counted = fact.groupBy("date_key", "time_key", "pickup_location_key").agg(
        F.count("*").alias("trips"), wide_sum(F.col("trip_duration")).alias("seconds"))
    joined = (counted.join(dates, "date_key").join(times, "time_key")
              .join(locations.select(F.col("location_key").alias("pickup_location_key"), "area"),
                    "pickup_location_key"))
    return joined.groupBy("year", "month", "time_of_day", F.col("area").alias("pickup_area")).agg(
        F.sum("trips").alias("trips"), F.sum("seconds").try_cast("bigint").alias("seconds"))
