"""Duration and speed measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripledger.functions.rounding import from_micro, micro

LONGEST_S = 10**15


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def speed_kmh(distance_km: Column, duration_s: Column) -> Column:
    """Kilometres per hour to six places; NULL without a distance or a positive duration.

    Whole millionths, rounded half-up. Halfway round the Earth in ``LONGEST_S`` seconds is below
    half a millionth, so a longer duration gives the same 0 and cannot overflow.
    """
    seconds = F.least(duration_s, F.lit(LONGEST_S))
    doubled = micro(distance_km) * F.lit(7200)
    return F.when(duration_s > 0, from_micro(
        F.call_function("div", doubled + seconds, seconds * 2)))
