"""From landing text to typed and derived trips. No row is removed here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.functions.calendar import calendar_fields
from tripledger.functions.geo import great_circle_km
from tripledger.functions.motion import seconds_between, speed_kmh
from tripledger.operators.once import computed_once
from tripledger.sources.contract import COLUMNS, LINEAGE_COLUMNS


def clean_text(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def typed(landed: DataFrame) -> DataFrame:
    """Parse landing text. A cell that does not parse becomes NULL and then fails its rule."""
    parsed = [clean_text(name).try_cast(kind).alias(name) for name, kind, _ in COLUMNS
              if name != "store_and_fwd_flag"]
    flag = F.trim("store_and_fwd_flag")
    return landed.select(
        *parsed,
        F.upper(flag).alias("store_and_fwd_flag_raw"),
        flag.alias("store_and_fwd_flag_original"),
        *[c for c in LINEAGE_COLUMNS if c in landed.columns],
    )


def typed_feed(trips: DataFrame) -> DataFrame:
    """Trips that already carry types, brought to the shape of `typed`."""
    flag = F.trim("store_and_fwd_flag")
    keep = [name for name, _, _ in COLUMNS if name != "store_and_fwd_flag"]
    return trips.select(
        *keep,
        F.upper(flag).alias("store_and_fwd_flag_raw"),
        flag.alias("store_and_fwd_flag_original"),
        *[c for c in LINEAGE_COLUMNS if c in trips.columns],
    )


def derived(trips: DataFrame, once: bool = False) -> DataFrame:
    """Add calendar fields, distance, speed and the two duration measures.

    With ``once`` the distance, which the speed and several rules need, is computed once per row."""
    observed = seconds_between(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    distance = great_circle_km(F.col("pickup_latitude"), F.col("pickup_longitude"),
                               F.col("dropoff_latitude"), F.col("dropoff_longitude"))
    measured = {"trip_duration_minutes": F.col("trip_duration").cast("double") / 60,
                **calendar_fields(F.col("pickup_datetime"))}
    distances = {"estimated_distance_km": distance}
    with_measures = (computed_once(trips.withColumns(measured), distances) if once
                     else trips.withColumns(measured | distances))
    return with_measures.withColumn("observed_duration_seconds", observed).withColumns({
        "estimated_speed_kmh": speed_kmh(F.col("estimated_distance_km"), F.col("trip_duration")),
        "duration_difference_seconds": F.try_subtract(F.col("observed_duration_seconds"),
                                                      F.col("trip_duration")),
    })
