"""Exact averages and percentiles by counting equal values first.

Rows are counted per (group, whole-second duration) before anything is brought together per
group. The first step combines map-side and spreads one big group over many tasks; what reaches
the second step is one row per distinct duration, however many trips the group has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.functions.rounding import MICRO, micro, ratio, wide_sum
from tripledger.operators.rank_index import RankIndex, interpolated
from tripledger.sources.stages import stored


# Columns of a cell that are added up when cells are merged.
CELL_SUMS = ("n", "n_km", "sum_km", "n_kmh", "sum_kmh", "n_slow")


def duration_cells(rows: DataFrame, keys: Sequence[str], low_speed: float | None = None,
                   keep: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per (keys, trip_duration): row count, distance and speed sums in millionths."""
    km, kmh = micro(F.col("estimated_distance_km")), micro(F.col("estimated_speed_kmh"))
    slow = F.lit(0).cast("bigint") if low_speed is None else F.count_if(
        F.col("estimated_speed_kmh") < low_speed)
    return rows.groupBy(*keys, "trip_duration").agg(
        F.count("*").alias("n"),
        F.count("estimated_distance_km").alias("n_km"),
        wide_sum(km).alias("sum_km"),
        F.count("estimated_speed_kmh").alias("n_kmh"),
        wide_sum(kmh).alias("sum_kmh"),
        slow.alias("n_slow"),
        *[c.alias(name) for name, c in (keep or {}).items()],
    )


def n_trips() -> Column:
    return F.sum("n")


def n_durations() -> Column:
    return F.sum(F.when(F.col("trip_duration").isNotNull(), F.col("n")))


def avg_duration(places: int, unit_seconds: int = 1) -> Column:
    total = F.sum(F.col("trip_duration").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)"))
    return ratio(total, n_durations() * unit_seconds, places)


def avg_km(places: int = 6) -> Column:
    return ratio(wide_sum(F.col("sum_km")), wide_sum(F.col("n_km")) * MICRO, places)


def avg_kmh(places: int = 6) -> Column:
    return ratio(wide_sum(F.col("sum_kmh")), wide_sum(F.col("n_kmh")) * MICRO, places)


def duration_percentiles(points: Sequence[float]) -> Column:
    """All points from one buffer of (distinct duration, count)."""
    return F.percentile("trip_duration", list(points), F.col("n"))


def exact_percentiles(values: DataFrame, points: Mapping[str, float]) -> DataFrame:
    """Exact percentiles of whole numbers, for any number of distinct values.

    ``values`` has columns (name, v bigint) and may have n, how often the value counts. Equal values are
    counted into a stored table, and a `RankIndex` over it gives the ranks.

    Returns (name, label, n, low, high, weight): the two neighbours of the position and the
    share of the upper one, as in linear interpolation.
    """
    weight = F.sum("n") if "n" in values.columns else F.count("*")
    cells = stored(values.where(F.col("v").isNotNull()).groupBy("name", "v").agg(weight.alias("n")),
                   "counted-values")
    found = RankIndex(cells, ["name"]).located(points)
    return found.select(F.col("group")["name"].alias("name"), "label", F.col("total").alias("n"),
                        "low", "high", "weight")


def percentile_columns(found: DataFrame, labels: Sequence[str], scale: int = 1,
                       places: int = 9) -> DataFrame:
    """One row per name with a column per label, in units of 1/scale.

    Between two millionths a percentile has up to nine digits, so nine are kept.
    """
    value = F.round(interpolated(F.col("low").cast("double"), F.col("high").cast("double"),
                                 F.col("weight")) / F.lit(float(scale)), places)
    return found.groupBy("name").agg(
        *[F.max(F.when(F.col("label") == label, value)).alias(label) for label in labels])


def cell_percentiles(cells: DataFrame, points: Mapping[str, float], key: str | None = None,
                     value: str = "trip_duration") -> DataFrame:
    """Percentiles of counted values (value, n), as columns by label, without one big buffer.

    One row, or with ``key`` one row per key: (key, labels). A group without values has no row.
    """
    keys = [] if key is None else [key]
    counted = stored(cells.groupBy(*keys, value).agg(F.sum("n").alias("n")), "counted-values")
    return RankIndex(counted, keys, value).percentiles(points, places=9)


def with_percentiles(groups: DataFrame, cells: DataFrame, points: Mapping[str, float],
                     keys: str | Sequence[str]) -> DataFrame:
    """Add each group's percentiles of its cells' durations. ``cells`` is read several times: pass a
    stored table with one row for each group and duration."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return RankIndex(cells, keys, "trip_duration").added_to(groups, points, places=9)


def as_units(rows: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Long form (name, v) of several whole-number columns, read in one scan."""
    pairs = F.array(*[F.struct(F.lit(name).alias("name"), c.cast("bigint").alias("v"))
                      for name, c in columns.items()])
    return rows.select(F.inline(pairs))
