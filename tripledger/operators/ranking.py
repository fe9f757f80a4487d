"""Row numbers over a whole group without sorting the group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_by_count(rows: DataFrame, group: str, count: str, head: str, key: str,
                  name: str) -> DataFrame:
    """Number rows 1.. inside ``group`` by ``count`` descending, then ``key`` ascending.

    ``head`` is a leading part of ``key`` that orders like it. The number is the sum of three:
    rows with a larger count, rows with the same count and a smaller head, and the place among
    the rest. Counts of trips are whole numbers that add up to the trips, so a group of N trips
    has at most sqrt(2N) distinct counts to order.
    """
    tie_sizes = rows.groupBy(group, count, head).agg(F.count("*").alias("size"))
    by_count = Window.partitionBy(group).orderBy(F.col(count).desc())
    larger = (
        tie_sizes.groupBy(group, count).agg(F.sum("size").alias("size"))
        .select(group, count, (F.sum("size").over(by_count) - F.col("size")).alias("larger"))
    )
    by_head = Window.partitionBy(group, count).orderBy(head)
    offsets = (
        tie_sizes.select(group, count, head,
                         (F.sum("size").over(by_head) - F.col("size")).alias("earlier"))
        .join(larger, [group, count])
        .select(group, count, head, (F.col("larger") + F.col("earlier")).alias("ahead"))
    )
    place = F.row_number().over(Window.partitionBy(group, count, head).orderBy(key))
    numbered = rows.join(offsets, [group, count, head])
    return numbered.select(*rows.columns, (F.col("ahead") + place).alias(name))
