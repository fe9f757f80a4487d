"""Exact percentiles of groups from one stored table of counted values and an index of ranks.

Equal values of a group are counted first and stored, so whoever needs a figure of the groups reads the
cells, not the rows. The index holds, for two coarser levels of a value's leading bits, how many values a
bucket has and how many come before it. A rank is looked up level by level; only the cells of a bucket
that holds a wanted rank are ever ordered, so no task orders all values of a group and no group is one
buffer, whatever its size or the number of its distinct values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.sources.stages import stored

# Bits dropped at each level: no step orders more than 2**22 buckets of a parent.
COARSE, FINE = 44, 22


class RankIndex:
    """``cells`` has the group columns ``keys``, a whole number ``value`` and its count ``n``, and one
    row for each combination; further columns are kept for other figures. It should be a stored table,
    as it is read for every level. Missing values have no rank."""

    def __init__(self, cells: DataFrame, keys: Sequence[str], value: str = "v"):
        self.keys = list(keys)
        self.cells = cells
        # Equality of records counts missing parts as equal, which a join by columns does not.
        group = F.struct(*self.keys) if self.keys else F.struct(F.lit(0).alias("none"))
        self._values = cells.where(F.col(value).isNotNull()).select(
            group.alias("group"), F.col(value).cast("bigint").alias("v"), "n")
        fine = self._values.groupBy("group", F.shiftright("v", FINE).alias("bucket")).agg(
            F.sum("n").alias("n"))
        coarse = Window.partitionBy("group", F.shiftright("bucket", COARSE - FINE)).orderBy("bucket")
        all_of = Window.partitionBy("group").orderBy("parent")
        levels = fine.withColumns({
            "parent": F.shiftright("bucket", COARSE - FINE),
            "before": F.sum("n").over(coarse) - F.col("n")})
        parents = levels.groupBy("group", "parent").agg(F.sum("n").alias("n")).withColumns({
            "parent_before": F.sum("n").over(all_of) - F.col("n"),
            "total": F.sum("n").over(Window.partitionBy("group"))}).drop("n")
        # Both levels in one table: a bucket's place among all values of its group is known.
        index = levels.join(parents.withColumnsRenamed({"group": "of", "parent": "parents"}), (
            F.col("group") == F.col("of")) & (F.col("parent") == F.col("parents")))
        self.index = stored(index.select(
            "group", "bucket", "n", (F.col("before") + F.col("parent_before")).alias("before"), "total"),
            "rank-index")

    def _hits(self, points: Mapping[str, float]) -> DataFrame:
        """(group, label, side, total, weight, v): the two neighbours of each position, below and above,
        and the share of the upper one, as in linear interpolation."""
        wanted = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(float(p)).alias("point"))
                           for label, p in points.items()])
        sides = F.array(F.struct(F.lit("low").alias("side"), F.floor("position").alias("rank")),
                        F.struct(F.lit("high").alias("side"), F.ceil("position").alias("rank")))
        held = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
        targets = (
            self.index.select("*", F.inline(wanted))
            .withColumn("position", (F.col("total") - 1) * F.col("point"))
            .select("group", "bucket", "n", "before", "total", "label",
                    (F.col("position") - F.floor("position")).alias("weight"), F.inline(sides))
            .where(held)
            .select(F.col("group").alias("of"), F.col("bucket").alias("in_bucket"), "label", "total",
                    "weight", "side", (F.col("rank") - F.col("before")).alias("rank")))
        place = (F.col("group") == F.col("of")) & (F.col("bucket") == F.col("in_bucket"))
        # Each wanted bucket is ordered once, however many ranks it holds.
        inside = self._values.withColumn("bucket", F.shiftright("v", FINE)).join(
            targets.select("of", "in_bucket").distinct(), place, "left_semi")
        order = Window.partitionBy("group", "bucket").orderBy("v")
        return (inside.withColumn("upto", F.sum("n").over(order)).join(targets, place)
                .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
                .select("group", "label", "side", "total", "weight", "v"))

    def located(self, points: Mapping[str, float]) -> DataFrame:
        """(group, label, total, weight, low, high) of each group with a value and each point."""
        return self._hits(points).groupBy("group", "label", "total", "weight").agg(
            F.max(F.when(F.col("side") == "low", F.col("v"))).alias("low"),
            F.max(F.when(F.col("side") == "high", F.col("v"))).alias("high"))

    def percentiles(self, points: Mapping[str, float], scale: int = 1, places: int | None = None
                    ) -> DataFrame:
        """(keys, labels): one row for each group with a value, in units of 1/scale."""
        def value(label: str) -> Column:
            mine = F.col("label") == label
            low, high = (F.max(F.when(mine & (F.col("side") == side), F.col("v"))).cast("double")
                         for side in ("low", "high"))
            found = interpolated(low, high, F.max(F.when(mine, F.col("weight")))) / F.lit(float(scale))
            return (found if places is None else F.round(found, places)).alias(label)
        found = self._hits(points).groupBy("group").agg(*[value(label) for label in points])
        return found.select(*[F.col("group")[k].alias(k) for k in self.keys], *points)

    def added_to(self, groups: DataFrame, points: Mapping[str, float], places: int | None = None
                 ) -> DataFrame:
        """``groups``, one row for each group, with a column for each point; NULL without a value."""
        found = self.percentiles(points, places=places)
        if not self.keys:
            row = found.select(F.struct(*points).alias("p"))
            return groups.select("*", row.scalar().alias("p")).select(
                *groups.columns, *[F.col(f"p.{label}").alias(label) for label in points])
        by_key = found.select(F.struct(*self.keys).alias("of"), *points)
        return groups.join(by_key, F.struct(*[F.col(k) for k in self.keys]) == F.col("of"),
                           "left").drop("of")


def interpolated(low: Column, high: Column, weight: Column) -> Column:
    return low + (high - low) * weight
