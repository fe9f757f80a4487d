import csv
import hashlib
from datetime import datetime

import pytest

from tests import planted
from tripledger.config import Settings
from tripledger.plans import pipeline
from tripledger.session import scratch_dir
from tripledger.sources import landing
from tripledger.sources.contract import SOURCE_COLUMNS
from tripledger.sources.tables import Store

SETTINGS = Settings()


def write_csv(path, values, columns=SOURCE_COLUMNS):
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, columns, extrasaction="ignore", restval="")
        writer.writeheader()
        writer.writerows(values)


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in box"  # a path that needs quoting
    folder.mkdir()
    first, second = planted.batches()
    write_csv(folder / "a.csv", first)
    write_csv(folder / "b.csv", second, SOURCE_COLUMNS[::-1])  # another order of columns
    return folder


def test_land_is_idempotent_and_replay_is_not(spark, inbox, tmp_path):
    store = landing.Landing(spark, str(tmp_path / "lake"))
    assert store.land(str(inbox))
    assert store.rows().count() == planted.TOTAL
    assert store.land(str(inbox)) is None and store.rows().count() == planted.TOTAL
    write_csv(inbox / "copy of a.csv", planted.batches()[0])  # known content, new name
    assert store.land(str(inbox)) is None
    write_csv(inbox / "c.csv", [planted.row(9000)])
    assert store.land(str(inbox)) and store.rows().count() == planted.TOTAL + 1
    assert store.land(str(inbox), force=True) and store.rows().count() == 2 * planted.TOTAL + 2
    assert sum(r.rows for r in store.log().collect()) == 2 * planted.TOTAL + 2


def test_rows_of_an_unlogged_load_are_invisible(spark, inbox, tmp_path):
    store = landing.Landing(spark, str(tmp_path / "lake"))
    store.land(str(inbox))
    half = store.rows().drop("load_id").limit(10)
    half.write.mode("append").parquet(f"{store.rows_path}/load_id=died")
    assert spark.read.parquet(store.rows_path).count() == planted.TOTAL + 10
    assert store.rows().count() == planted.TOTAL


def test_hash_is_that_of_the_bytes(spark, inbox):
    hashes = landing.file_hashes(landing.list_files(spark, str(inbox))).collect()
    want = {f.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in inbox.iterdir()}
    assert {r.source_file: r.source_hash for r in hashes} == want


def test_stamp_ties_rows_to_their_file(spark, inbox, tmp_path):
    store = landing.Landing(spark, str(tmp_path / "lake"))
    store.land(str(inbox))
    stamped = store.rows().groupBy("source_file", "source_hash", "ingested_at").count().collect()
    assert {(r.source_file, r["count"]) for r in stamped} == {
        ("a.csv", len(planted.batches()[0])), ("b.csv", len(planted.batches()[1]))}
    assert len({r.ingested_at for r in stamped}) == 1


def test_rows_are_read_by_name_and_short_files_are_refused(spark, inbox, tmp_path):
    write_csv(inbox / "short.csv", [planted.row(7000)], SOURCE_COLUMNS[:-1])
    write_csv(inbox / "wide.csv", [planted.row(7001) | {"tip": "9"}], ("tip", *SOURCE_COLUMNS))
    store = landing.Landing(spark, str(tmp_path / "lake"))
    store.land(str(inbox))
    got = {r.id: r.asDict() for r in store.rows().where("id LIKE 'trip-%'").collect()}
    for values in [*planted.batches()[1], planted.row(7001)]:
        if values["id"].strip() and planted.rows().count(values) <= 1:
            assert {c: got[values["id"]][c] or "" for c in SOURCE_COLUMNS} == values
    assert "trip-7000" not in got
    refused = store.refused().collect()
    assert [(r.source_file, r.missing) for r in refused] == [("short.csv", ["trip_duration"])]
    assert "short.csv" not in {r.source_file for r in store.log().collect()}


@pytest.mark.parametrize("near", [0, 10_000])
def test_only_the_first_line_is_a_header(spark, inbox, near):
    """A later line that repeats the header is a row, whether files are broadcast or met in parts."""
    with open(inbox / "a.csv", "a", newline="") as out:
        csv.writer(out).writerow(SOURCE_COLUMNS)
    with open(inbox / "empty.csv", "w") as out:
        out.write("")
    heads = landing.headers(landing.list_files(spark, str(inbox)))
    rows = landing.read_text_rows(spark, str(inbox), heads, near)
    found = rows.groupBy("file_path").count().collect()
    assert {r.file_path.rsplit("/", 1)[1]: r["count"] for r in found} == {
        "a.csv": len(planted.batches()[0]) + 1, "b.csv": len(planted.batches()[1])}
    assert rows.where("id = 'id' AND vendor_id = 'vendor_id'").count() == 1


def test_running_totals_of_many_days(spark):
    log = spark.range(300).selectExpr(
        "concat('l', id) AS load_id", "id % 7 AS rows",
        "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 11 AS int), cast(id % 5 AS int)) "
        "AS ingested_at")
    got = landing.running_totals(log).orderBy("at", "load_id").collect()
    total = 0
    for r in got:
        total += r.rows
        assert r.rows_in_total == total
    assert len(got) == 300


def test_only_a_missing_folder_is_an_empty_log(spark, tmp_path):
    store = landing.Landing(spark, str(tmp_path / "lake"))
    assert store.log().count() == 0 and store.refused().count() == 0
    store.log_path = "nosuchscheme://x/y"
    with pytest.raises(Exception, match="nosuchscheme|scheme"):
        store.log().count()


def test_addresses_of_object_stores():
    assert landing.address("s3a://b/k.csv") == "s3://b/k.csv"
    assert landing.address("file:/a b/c.csv") == "file:///a b/c.csv"
    assert landing.address("hdfs://n:1/x") == "hdfs://n:1/x"


def test_running_totals_order_loads_of_one_time_by_id(spark):
    log = spark.sql("SELECT * FROM VALUES ('b', 5L, timestamp_ntz'2024-01-01'), "
                    "('a', 2L, timestamp_ntz'2024-01-01'), ('a', 1L, timestamp_ntz'2024-01-01'), "
                    "('c', 9L, timestamp_ntz'2023-01-01') AS t(load_id, rows, ingested_at)")
    got = {r.load_id: r.rows_in_total for r in landing.running_totals(log).collect()}
    assert got == {"c": 9, "a": 12, "b": 17}


def test_drift_status(spark, tmp_path):
    write_csv(tmp_path / "same.csv", [])
    write_csv(tmp_path / "short.csv", [], SOURCE_COLUMNS[:-1])
    write_csv(tmp_path / "wide.csv", [], (*SOURCE_COLUMNS, "tip"))
    write_csv(tmp_path / "turned.csv", [], SOURCE_COLUMNS[::-1])
    found = landing.schema_drift(landing.headers(landing.list_files(spark, str(tmp_path))))
    assert {r.file_path.rsplit("/", 1)[1]: r.profile_status for r in found.collect()} == {
        "same.csv": "PASS", "short.csv": "FAIL", "wide.csv": "WARNING", "turned.csv": "WARNING"}


def test_build_from_files_twice_gives_the_same_tables(spark, inbox, tmp_path):
    store = landing.Landing(spark, str(tmp_path / "lake"))
    store.land(str(inbox))
    root = scratch_dir(spark, "build")
    first = pipeline.build(store.rows(), Store(spark, root), SETTINGS)
    counts = {name: rows.count() for name, rows in first.items()}
    assert (counts["silver_trips"], counts["silver_trips_quarantine"]) == (
        planted.VALID, planted.TOTAL - planted.VALID)
    quality = first["data_quality"].collect()
    assert sum(q.total_records for q in quality) == planted.TOTAL and all(q.reconciles for q in quality)
    kept = {n: first[n].collect() for n in ("vendor_performance", "data_quality")}
    again = pipeline.build(store.rows(), Store(spark, root), SETTINGS)
    for name, rows in kept.items():
        assert sorted(map(str, again[name].collect())) == sorted(map(str, rows))
    tables = pipeline.write_profile(planted.landed(spark), again["silver_dq_evaluated"],
                                    Store(spark, root), SETTINGS, "RUN", datetime(2024, 1, 1))
    assert {n: t.count() for n, t in tables.items() if n != "profile_domain_stats"} == {
        "profile_run": 1, "profile_schema": 11, "profile_numeric_stats": 3,
        "profile_quality": 15, "profile_anomalies": 7}


def test_models_and_tests_run_by_name_with_their_parents(spark, inbox, tmp_path):
    root = scratch_dir(spark, "by-name")
    text = planted.landed(spark)
    assert pipeline.with_parents(["vendor_performance"]) == [
        "silver_dq_evaluated", "silver_trips", "vendor_performance"]
    built = pipeline.build(text, Store(spark, root), SETTINGS, select=["vendor_performance"])
    assert list(built) == pipeline.with_parents(["vendor_performance"])
    store = Store(spark, root)
    with pytest.raises(KeyError):
        store.read("gold", "demand_metrics")
    alone = pipeline.build(text.limit(0), store, SETTINGS, select=["demand_metrics"], parents=False)
    assert list(alone) == ["demand_metrics"]  # made of the stored trips
    total = alone["demand_metrics"].agg({"kpi_008_trips_per_hour": "sum"}).first()[0]
    assert total == planted.VALID
    found = pipeline.check(store, SETTINGS, ["vendor_share_100", "duration_positive", "vendor_unique"])
    assert {r.check: r.offending_rows for r in found.collect()} == {
        "vendor_share_100": 0, "duration_positive": 0, "vendor_unique": 0}
    store.replace("silver", "silver_trips", store.read("silver", "silver_trips").selectExpr(
        "* EXCEPT (trip_duration)", "-1L AS trip_duration").limit(3))
    assert pipeline.check(store, SETTINGS, ["duration_positive"]).first().offending_rows == 3
    for wrong in (lambda: pipeline.check(store, SETTINGS, ["nothing"]),
                  lambda: pipeline.build(text, store, SETTINGS, select=["nothing"])):
        with pytest.raises(KeyError, match="nothing"):
            wrong()


def test_a_failed_replacement_keeps_the_old_table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "tables"))
    old = store.replace("gold", "t", spark.range(3))
    with pytest.raises(Exception, match="broken"):
        store.replace("gold", "t", spark.range(5).selectExpr("raise_error('broken') AS id"))
    assert store.read("gold", "t").count() == 3
    store.replace("gold", "t", spark.range(7))
    assert store.read("gold", "t").count() == spark.table("gold_t").count() == 7
    assert old.count() == 3  # a reader of the old version is not disturbed
    with pytest.raises(KeyError):
        store.read("gold", "missing")
