"""What a build leaves on disk: tables nobody needs any more go, and so do the files of shuffles."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests import planted
from tripledger import catalog
from tripledger.config import Settings
from tripledger.plans.pipeline import GOLD, MODELS, build
from tripledger.sources.stages import stored
from tripledger.sources.tables import Store


def files(root, layer="*", name="*"):
    return sorted(Path(root).glob(f"{layer}/{name}/*/part-*"))


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found, each = set(), disk.getAllFiles().iterator()
    while each.hasNext():
        name = each.next().getName()
        if name.startswith("shuffle_"):
            found.add(name)
    return found


def test_a_dropped_table_is_gone_and_can_be_written_anew(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    old = store.replace("silver", "a", spark.range(3))
    store.replace("silver", "a", spark.range(5))
    store.replace("silver", "b", spark.range(7))
    store.drop("silver", "a")
    assert old.count() == 3  # an older version is left to its readers
    assert len({f.parent for f in files(tmp_path / "t", "silver", "a")}) == 1
    for gone in (lambda: store.read("silver", "a"), lambda: store.drop("silver", "a"),
                 lambda: store.replace_partitions("silver", "a", spark.range(1))):
        with pytest.raises(KeyError):
            gone()
    assert store.read("silver", "b").count() == 7
    assert store.replace("silver", "a", spark.range(2)).count() == 2
    assert store.read("silver", "a").count() == 2
    assert store.versions("silver", "a") == [1, 2, 3, 4]


def test_a_build_keeps_what_is_wanted_and_makes_the_same_marts(spark, tmp_path):
    text, settings = planted.landed(spark), Settings()
    whole = build(text, Store(spark, str(tmp_path / "whole")), settings)
    store = Store(spark, str(tmp_path / "marts"))
    marts = build(text, store, settings, keep=GOLD)
    assert set(whole) == set(MODELS) and set(marts) == set(GOLD)
    assert files(tmp_path / "whole", "silver") and not files(tmp_path / "marts", "silver")
    for name in GOLD:
        assert sorted(map(str, marts[name].collect())) == sorted(map(str, whole[name].collect()))
    with pytest.raises(KeyError):
        store.read("silver", "silver_trips")


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(10_000).groupBy((F.col("id") % 997).alias("k")).agg(F.sum("id").alias("n"))
    held = [rows, Store(spark, str(tmp_path / "t")).replace("gold", "a", rows), stored(rows, "a")]
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)  # they are deleted in the background
    assert not shuffle_files(spark) - before
    assert [r.count() for r in held] == [997] * 3


def test_two_builds_are_compared_without_two_sets_of_silver_tables(spark, tmp_path, monkeypatch):
    rows = [(k, 7 * k % 400, k % 50, 1 + k % 7, "RAN"[k % 3]) for k in range(1, 900)]
    rows += rows[:40]
    (spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                 "l_returnflag string")
     .withColumn("l_shipdate", F.expr("timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, l_partkey)"))
     .write.parquet(str(tmp_path / "in/lineitem.parquet")))
    monkeypatch.setattr(catalog, "scratch_dir", lambda spark, purpose: str(tmp_path / purpose))
    found = {r.mart: r for r in catalog.QUERIES["gold_idempotent"](spark, str(tmp_path / "in")).collect()}
    assert set(found) == set(GOLD)
    assert all(r.rows > 0 and r.differing_rows == 0 for r in found.values())
    store = tmp_path / "build"
    assert not files(store, "silver") and not files(store, "bronze")
    assert {f.parents[1].name for f in files(store, "gold")} == set(GOLD)
