"""Calendar fields of a wall-clock pickup time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First hour of each part of the day; every other hour, and no hour, is Night.
DAY_PARTS = (("Morning", 5, 11), ("Afternoon", 12, 16), ("Evening", 17, 20))


def time_of_day(ts: Column) -> Column:
    hour = F.hour(ts)
    label = F.lit("Night")
    for name, first, last in reversed(DAY_PARTS):
        label = F.when((hour >= first) & (hour <= last), name).otherwise(label)
    return label


def is_weekend(ts: Column) -> Column:
    """Saturday or Sunday; an unknown time is not a weekend."""
    return F.coalesce(F.dayofweek(ts).isin(1, 7), F.lit(False))


def calendar_fields(ts: Column) -> dict[str, Column]:
    return {
        "pickup_date": F.to_date(ts),
        "pickup_year": F.year(ts),
        "pickup_month": F.month(ts),
        "pickup_week": F.weekofyear(ts),
        "pickup_day": F.dayofmonth(ts),
        "day_of_week": F.date_format(ts, "EEEE"),
        "pickup_hour": F.hour(ts),
        "is_weekend": is_weekend(ts),
        "time_of_day": time_of_day(ts),
    }
