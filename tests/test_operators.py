import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripledger.functions.geo import great_circle_km
from tripledger.functions.motion import speed_kmh
from tripledger.functions.rounding import ratio
from tripledger.operators.histogram import (
    cell_percentiles, exact_percentiles, percentile_columns,
)
from tripledger.operators.occurrences import only_once, with_id_occurrences
from tripledger.operators.ranking import rank_by_count

# One id holds a third of the rows, some rows have none, others repeat a little.
IDS = ["hot"] * 100 + [None] * 50 + [f"twice{i // 2}" for i in range(40)] + [
    f"once{i}" for i in range(110)]


@pytest.mark.parametrize("share", [2, 4, 100_000])
def test_occurrences_by_broadcast_and_by_shuffle(spark, share):
    rows = spark.createDataFrame([(i, k) for k, i in enumerate(IDS)], "id string, k int")
    counts = Counter(i for i in IDS if i is not None)
    found = with_id_occurrences(rows.repartition(3), share).collect()
    assert len(found) == len(IDS)
    assert all(r.id_occurrences == (counts[r.id] if r.id else None) for r in found)


def test_occurrences_without_broadcast_by_the_planner(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        test_occurrences_by_broadcast_and_by_shuffle(spark, 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_once_keeps_whole_rows(spark):
    rows = spark.createDataFrame([(i, k, None if k % 2 else str(k)) for k, i in enumerate(IDS)],
                                 "id string, k int, text string")
    found = sorted((r.id, r.k, r.text) for r in only_once(rows).collect())
    counts = Counter(IDS)
    assert found == sorted((i, k, None if k % 2 else str(k)) for k, i in enumerate(IDS)
                           if i is not None and counts[i] == 1)


@pytest.mark.parametrize("values", [
    list(range(1000)), [7], [5, 5, 5, 9], [-(10**13), -3, 0, 4, 2**45, 2**60],
    [k * k * k - 10**6 for k in range(500)] + [42] * 400,
])
def test_percentiles_match_linear_interpolation(spark, values):
    points = {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p999": 0.999, "max": 1.0}
    rows = spark.createDataFrame([("x", v) for v in values] + [("x", None), ("y", 3)],
                                 "name string, v bigint")
    found = {r.name: r for r in percentile_columns(
        exact_percentiles(rows, points), list(points)).collect()}
    for label, p in points.items():
        assert found["x"][label] == pytest.approx(np.quantile(np.array(values, float), p), rel=1e-9)
        assert found["y"][label] == 3


def test_rank_by_count_matches_one_sort(spark):
    rows = [(g, (k * 7) % 5, f"{k % 4}", f"{k % 4} -> {k * 13 % 101:03}")
            for g in ("a", "b") for k in range(101)]
    frame = spark.createDataFrame(rows, "g string, n bigint, head string, key string")
    ranked = rank_by_count(frame, "g", "n", "head", "key", "place").collect()
    for g in ("a", "b"):
        mine = sorted((r for r in ranked if r.g == g), key=lambda r: (-r.n, r.key))
        assert [r.place for r in mine] == list(range(1, 102))


def test_ratio_is_half_up_in_both_directions(spark):
    cases = [(1, 8, 2), (-1, 8, 2), (5, 2, 0), (2, 3, 4), (10**24, 7 * 10**10, 3)]
    for num, den, places in cases:
        got = spark.range(1).select(ratio(F.lit(str(num)).cast("decimal(38,0)"), F.lit(den),
                                          places)).first()[0]
        exact = Fraction(abs(num), den) * 10**places
        want = math.floor(exact + Fraction(1, 2)) / 10**places * (1 if num > 0 else -1)
        assert got == pytest.approx(want, rel=1e-15)
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0), 2)).first()[0] is None


def test_distance_and_speed(spark):
    def km(*c):
        return spark.range(1).select(great_circle_km(*[F.lit(x) for x in c])).first()[0]

    assert km(0.0, 0.0, 0.0, 180.0) == pytest.approx(math.pi * 6371, abs=1e-5)
    assert km(40.7, -74.0, 40.7, -74.0) == 0.0
    assert km(40.7, None, 40.7, -74.0) is None
    assert km(float("nan"), -74.0, 40.7, -74.0) is None

    def kmh(distance, seconds):
        return spark.range(1).select(speed_kmh(F.lit(distance).cast("double"),
                                               F.lit(seconds).cast("bigint"))).first()[0]

    assert kmh(1.5, 7) == 771.428571
    assert kmh(1.5, 0) is None and kmh(1.5, -3) is None and kmh(None, 7) is None


def test_rows_without_id_and_of_a_hot_id_are_not_dealt_out_by_id(spark):
    rows = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, None).when(F.col("id") % 4 == 1, "hot")
        .otherwise(F.concat(F.lit("i"), F.floor(F.col("id") / 8).cast("string"))).alias("id"), "id")
    rows = rows.toDF("id", "k")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",
                                             "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        found = with_id_occurrences(rows, 1000)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        hot = found.where("id = 'hot'").select("id_occurrences").distinct().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [r.id_occurrences for r in hot] == [10_000]
    assert max(sizes) <= 5_000  # no task holds more than what its own read gave it


def test_percentiles_of_cells_equal_one_buffer(spark):
    cells = spark.range(1, 400).select(
        F.when(F.col("id") % 5 != 0, (F.col("id") % 3).cast("int")).alias("g"),
        (F.col("id") * 7919 % 1000 - 300).alias("trip_duration"), (F.col("id") % 4 + 1).alias("n"))
    found = cell_percentiles(cells, {"p50": 0.5, "p90": 0.9}, "g").collect()
    want = cells.groupBy("g").agg(F.percentile("trip_duration", [0.5, 0.9], F.col("n")).alias("p"))
    assert {r.g: (r.p50, r.p90) for r in found} == {
        r.g: tuple(pytest.approx(x) for x in r.p) for r in want.collect()}
    whole = cell_percentiles(cells, {"p90": 0.9}).first().p90
    assert whole == pytest.approx(cells.agg(F.percentile("trip_duration", 0.9, F.col("n"))).first()[0])
