"""Tables by a log of versions, and KPI tables kept up to date batch by batch."""

import pytest
from pyspark.sql import functions as F

from tests import planted
from tripledger.config import PENDING, Settings, UnapprovedThreshold
from tripledger.operators import rules
from tripledger.operators.typing import typed
from tripledger.plans import marts
from tripledger.plans.expectations import compare
from tripledger.plans.incremental import LAYER, NAME, Incremental, latest_versions
from tripledger.sources.tables import Conflict, Store

SETTINGS = Settings()


def test_of_two_writers_one_gets_an_error_and_no_version_is_lost(spark, tmp_path):
    one, two = (Store(spark, str(tmp_path / "t")) for _ in range(2))
    one.replace("gold", "t", spark.range(3))
    number, _ = two.current("gold", "t")
    one.replace("gold", "t", spark.range(4))
    with pytest.raises(Conflict):
        two.commit("gold", "t", number + 1, {"version": "x"})
    assert one.versions("gold", "t") == [1, 2] and two.read("gold", "t").count() == 4
    two.replace("gold", "t", spark.range(5))
    assert one.read("gold", "t").count() == 5


def test_a_writer_that_dies_over_its_entry_leaves_the_version_before(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    store.replace("gold", "t", spark.range(3))
    files, target = store._file(f"{store.root}/_log/gold/t/{2:012}.json")
    files.create(target, False).close()
    assert store.read("gold", "t").count() == 3
    assert store.replace("gold", "t", spark.range(6)).count() == 6
    assert store.versions("gold", "t") == [1, 2, 3]


def test_partitions_are_replaced_and_pruned(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    rows = spark.range(40).select("id", (F.col("id") % 4).cast("int").alias("p"),
                                  F.lit("a b").alias("q"))
    table = store.replace("gold", "t", rows, ["p", "q"])
    assert table.columns == ["id", "p", "q"] and table.count() == 40
    old = store.read("gold", "t")
    new = spark.range(100, 103).select("id", F.lit(2).alias("p"), F.lit("a b").alias("q"))
    mixed = store.replace_partitions("gold", "t", new.unionByName(
        spark.range(1).select("id", F.lit(9).alias("p"), F.lit(None).cast("string").alias("q"))))
    assert {r.p: r["count"] for r in mixed.groupBy("p").count().collect()} == {0: 10, 1: 10, 2: 3, 3: 10, 9: 1}
    assert old.count() == 40
    assert len(mixed.where("p = 2").inputFiles()) >= 1
    chosen = mixed.where("p = 2")
    assert sorted(r.id for r in chosen.collect()) == [100, 101, 102]
    with pytest.raises(KeyError):
        store.replace("gold", "plain", spark.range(2))
        store.replace_partitions("gold", "plain", spark.range(2))
    assert spark.sql("SELECT count(*) AS n FROM gold_t WHERE p = 3").first().n == 10


def deliveries(spark):
    """Three batches that repeat ids of each other, of themselves, and ids repeated before."""
    first, second = planted.batches()
    third = [planted.row(5), planted.row(6), planted.row(6), planted.row(151), planted.row(9001),
             planted.row(9002), planted.row(9001, passenger_count="9"), planted.row(9003, id=""),
             *[v for v in first[-3:]]]
    return [planted.landed(spark, v, name) for v, name in ((first, "b1"), (second, "b2"), (third, "b3"))]


def whole(rows):
    judged = rules.evaluate(rows, SETTINGS).cache()
    valid, rejected = rules.split(judged, SETTINGS)
    return {"trip_performance": marts.trip_performance(valid, SETTINGS),
            "demand_metrics": marts.demand_metrics(valid),
            "geographic_metrics": marts.geographic_metrics(valid),
            "vendor_performance": marts.vendor_performance(valid),
            "data_quality": marts.data_quality(judged, valid, rejected)}


@pytest.fixture(scope="module")
def states(spark, tmp_path_factory):
    batches = [typed(b) for b in deliveries(spark)]
    state = Incremental(spark, str(tmp_path_factory.mktemp("state")), SETTINGS)
    return state, batches


def test_marts_of_batches_equal_a_whole_build(spark, states):
    state, batches = states
    so_far = None
    for batch in batches:
        assert state.update(batch)
        if so_far is None:
            so_far = batch
            continue
        so_far = so_far.unionByName(batch)
        want, got = whole(so_far), state.marts()
        for name, table in want.items():
            result = compare(table, got[name].select(*table.columns)).first()
            assert result.differing_rows == 0, name
    assert state.update(so_far) is None  # known batches change nothing
    assert state.quality().agg(F.sum("total_records")).first()[0] == so_far.count()


def test_only_the_last_batch(states):
    state, batches = states
    assert {r.source_hash for r in state.quality(latest_only=True).collect()} == {"b3"}
    total = state.marts(latest_only=True)["demand_metrics"].agg(F.sum("kpi_008_trips_per_hour")).first()[0]
    assert total == state.quality(latest_only=True).first().valid_records == 1  # trip-9002 alone


def test_an_update_on_an_old_state_is_refused(spark, tmp_path):
    one, two = (Incremental(spark, str(tmp_path / "s"), SETTINGS) for _ in range(2))
    batches = [typed(b) for b in deliveries(spark)]
    one.update(batches[0])
    number, entry = two._state()
    one.update(batches[1])
    two._state = lambda: (number, entry)  # it began before the other one had ended
    with pytest.raises(Conflict):
        two.update(batches[2])
    assert len(one.store.current(LAYER, NAME)[1]["loads"]) == 2
    with pytest.raises(KeyError):
        Incremental(spark, str(tmp_path / "none"), SETTINGS).marts()
    with pytest.raises(UnapprovedThreshold):
        Incremental(spark, str(tmp_path / "s"), Settings(long_trip_seconds=PENDING)).marts()


def test_a_correction_in_a_later_batch_replaces_the_row(spark):
    rows = spark.createDataFrame([
        ("a", 1, "f1"), ("a", 2, "f2"), ("b", 1, "f1"), ("b", 1, "f1"), ("c", 2, "f2"), (None, 1, "f1"),
        ("d", 1, "f1"), ("d", 2, "f2"), ("d", 2, "f2"), ("e", 1, "f1"), ("e", 1, "f0")],
        "id string, ingested_at int, source_hash string")
    left = sorted(map(tuple, latest_versions(rows).collect()), key=str)
    assert left == sorted([("a", 2, "f2"), ("b", 1, "f1"), ("b", 1, "f1"), ("c", 2, "f2"), (None, 1, "f1"),
                           ("d", 2, "f2"), ("d", 2, "f2"), ("e", 1, "f1")], key=str)
