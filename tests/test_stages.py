"""Columns computed once, stage tables, the index of ranks, id bitmaps, and exact second moments."""

import io
import random
from collections import Counter
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import planted
from tripledger.config import Settings
from tripledger.operators import rules
from tripledger.operators.moments import correlation, deviation
from tripledger.operators.occurrences import (
    id_bitmap, only_once, repeated_ids, with_id_occurrences,
)
from tripledger.operators.once import computed_once, settled
from tripledger.operators.rank_index import RankIndex
from tripledger.operators.typing import typed
from tripledger.sources.stages import Stages


def plan(frame):
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain()
    return out.getvalue()


def test_a_derived_column_is_computed_once(spark):
    rows = spark.range(100).withColumn("x", F.sin(F.col("id") * 0.1))

    def used(frame):
        return frame.where("x > 0 OR x < -0.5").select("id", (F.col("x") + F.col("x")).alias("y"))
    plain, once = used(rows), used(settled(rows))
    assert plan(once).count("SIN(") == 1 < plan(plain).count("SIN(")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, plain.collect()))
    assert computed_once(rows, {"id": F.col("id") + 1}).columns == ["id", "x"]


def test_a_frame_is_written_once_whoever_asks(spark, tmp_path):
    stages = Stages(spark)
    one = stages.table(spark.range(10).where("id > 3"), "t")
    assert stages.table(spark.range(10).where("id > 3"), "other") is one
    assert stages.table(spark.range(10).where("id > 4"), "t") is not one
    assert stages.table(spark.range(10).where("id > 3").withColumnRenamed("id", "k"), "t").columns == ["k"]
    assert one.count() == 6


@pytest.mark.parametrize("spread", [3, 10**4, 2**60])
def test_rank_index_of_groups_equals_one_buffer(spark, spread):
    draw = random.Random(spread)
    rows = [(draw.choice([None, 1, 2]), draw.choice(["a", None]), None if k % 17 == 0 else
             draw.randrange(-spread, spread), draw.randrange(1, 5)) for k in range(600)]
    cells = spark.createDataFrame(rows, "g int, h string, v bigint, n bigint").groupBy(
        "g", "h", "v").agg(F.sum("n").alias("n"))
    points = {"low": 0.0, "mid": 0.5, "p90": 0.9, "top": 1.0}
    index = RankIndex(cells, ["g", "h"])
    got = {(r.g, r.h): [r[p] for p in points] for r in index.percentiles(points).collect()}
    values = {}
    for g, h, v, n in rows:
        if v is not None:
            values.setdefault((g, h), []).extend([v] * n)
    assert got.keys() == values.keys()
    for key, found in got.items():
        want = np.quantile(np.array(values[key], float), list(points.values()))
        assert found == pytest.approx(want, rel=1e-9, abs=1e-6)
    groups = cells.groupBy("g", "h").count()
    assert index.added_to(groups, points).count() == groups.count()
    whole = RankIndex(cells, []).percentiles({"mid": 0.5}).first().mid
    assert whole == pytest.approx(np.median([v for vs in values.values() for v in vs]), rel=1e-9)
    nothing = spark.createDataFrame([("x", None, 3)], "g string, v bigint, n bigint")
    empty = RankIndex(nothing, ["g"])
    assert empty.percentiles({"p": 0.5}).count() == 0
    assert empty.added_to(nothing.select("g"), {"p": 0.5}).collect()[0].p is None
    assert RankIndex(nothing, []).added_to(spark.range(1), {"p": 0.5}).collect()[0].p is None


def test_failed_rules_are_the_bits_of_the_pass_columns(spark):
    judged = rules.evaluate(typed(planted.landed(spark)), Settings()).collect()
    for r in judged:
        failed = [k for k in rules.CHECKED if not r[k.column]]
        assert r[rules.FAILED] == rules.bits(failed)
        rejecting = [k for k in failed if k.action == "reject"]
        assert r.is_valid_trip == (not rejecting)
        assert (r.rule_id, r.quarantine_reason) == (
            (rejecting[0].rule_id, rejecting[0].outcome) if rejecting else (None, None))
        for k in rules.FLAGGING:
            assert r[k.outcome] == (k in failed)


def test_bitmaps_are_merged_by_or_and_miss_no_id(spark):
    ids = [spark.range(a, b).select(F.concat(F.lit("i"), "id").alias("id")) for a, b in (
        (0, 400), (300, 900))]
    parts = id_bitmap(ids[0]).unionByName(id_bitmap(ids[1]))
    merged = {r.word: r.bits for r in parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()}
    assert merged == {r.word: r.bits for r in id_bitmap(ids[0].union(ids[1])).collect()}


@pytest.mark.parametrize("near", [0, 100_000])
@pytest.mark.parametrize("share", [2, 100_000])
def test_occurrences_with_many_repeated_ids(spark, near, share):
    ids = ["hot"] * 90 + [None] * 40 + [f"twice{i // 2}" for i in range(60)] + [f"o{i}" for i in range(99)]
    rows = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "id string, k int").repartition(3)
    counts = Counter(i for i in ids if i)
    found = with_id_occurrences(rows, share, near).collect()
    assert sorted(r.k for r in found) == list(range(len(ids)))
    assert all(r.id_occurrences == (counts[r.id] if r.id else None) for r in found)
    assert sorted(r.k for r in only_once(rows, share, near).collect()) == [
        k for k, i in enumerate(ids) if counts.get(i) == 1]
    assert {r.id: r.n for r in repeated_ids(rows).collect()} == {i: n for i, n in counts.items() if n > 1}


def test_moments_are_exact_where_doubles_cancel(spark):
    draw = random.Random(1)
    base = 3 * 10**11
    rows = [(base + draw.randrange(50), base * 2 + draw.randrange(50)) for _ in range(400)]
    rows = [(a, b + (a - base)) for a, b in rows] + [(None, 4), (base, None)]
    frame = spark.createDataFrame(rows, "x bigint, y bigint")
    got = frame.select(deviation(F.col("x")).alias("s"), deviation(F.col("x"), 1000).alias("k"),
                       correlation(F.col("x"), F.col("y")).alias("r")).first()
    xs = np.array([a - base for a, _ in rows if a is not None], float)
    both = np.array([(a - base, b - 2 * base) for a, b in rows if a is not None and b is not None], float)
    assert got.s == pytest.approx(xs.std(ddof=1), rel=1e-13)
    assert got.k == pytest.approx(xs.std(ddof=1) / 1000, rel=1e-13)
    assert got.r == pytest.approx(np.corrcoef(both.T)[0, 1], rel=1e-12)
    shuffled = frame.repartition(7, "y").select(correlation(F.col("x"), F.col("y"))).first()[0]
    assert shuffled == got.r  # the same bits in any order


def test_moments_of_few_and_of_huge_values(spark):
    for values, want in (([], None), ([5], None), ([5, 5], 0.0), ([-3, 4], np.std([-3, 4], ddof=1)),
                         ([2**63 - 1, -2**63, 7], np.std([2.0**63, -2.0**63, 7], ddof=1))):
        frame = spark.createDataFrame([(v,) for v in values], "x bigint")
        assert frame.select(deviation(F.col("x"))).first()[0] == (
            want if want is None else pytest.approx(want, rel=1e-9))
    same = spark.createDataFrame([(1, 2), (1, 3)], "x bigint, y bigint")
    assert same.select(correlation(F.col("x"), F.col("y"))).first()[0] is None


def scans(frame):
    """Scans of the source in the plan as it is made, subqueries included."""
    return frame._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet")


@pytest.mark.parametrize("name", ["exec_tiles", "vendor_performance", "geographic_metrics", "star_schema",
                                  "data_quality", "quarantine", "silver_trips"])
def test_queries_plan_few_scans_of_their_source(spark, name):
    from tripledger.catalog import QUERIES
    sf_dir = "/root/testdata/sf0.001"
    import os
    if not os.path.isdir(sf_dir):
        pytest.skip("test tables are not here")
    assert scans(QUERIES[name](spark, sf_dir)) <= 4
