import pytest
from pyspark.sql import functions as F

from tests import planted
from tripledger.config import PENDING, Settings, UnapprovedThreshold, gate
from tripledger.operators import rules
from tripledger.operators.typing import typed
from tripledger.plans import distributions as dist
from tripledger.plans import kpis, marts, panels, profile, star
from tripledger.plans.expectations import compare

SETTINGS = Settings()
BLOCKED = Settings(long_trip_seconds=PENDING)


@pytest.fixture(scope="module")
def valid(spark):
    return rules.valid_trips(typed(planted.landed(spark)), SETTINGS).cache()


def test_totals_agree_across_marts(valid):
    assert marts.trip_performance(valid, SETTINGS).agg(F.sum("kpi_001_total_trips")).first()[0] == planted.VALID
    assert marts.demand_metrics(valid).agg(F.sum("kpi_008_trips_per_hour")).first()[0] == planted.VALID
    shares = marts.vendor_performance(valid).agg(F.sum("kpi_013_vendor_trip_share_pct")).first()[0]
    assert shares == pytest.approx(100, abs=0.01)


def test_peak_hour_takes_the_earliest_of_equal_hours(spark):
    def at(i, hour):
        return planted.row(i, pickup_datetime=f"2016-03-01 {hour:02}:10:00",
                           dropoff_datetime=f"2016-03-01 {hour:02}:20:00", trip_duration="600")

    for order in ((9, 9, 3, 3, 5), (3, 5, 9, 3, 9)):
        rows = [at(i, h) for i, h in enumerate(order)]
        found = marts.demand_metrics(rules.valid_trips(typed(planted.landed(spark, rows)), SETTINGS))
        day = found.select("kpi_009_peak_hour", "kpi_009_peak_hour_trip_count",
                           "kpi_007_trips_per_day").distinct().collect()
        assert [tuple(d) for d in day] == [(3, 2, 5)]


def test_ranks_are_complete_and_agree_with_the_top_rows(valid):
    ranked = marts.geographic_metrics(valid).collect()
    by_dimension = {}
    for r in ranked:
        by_dimension.setdefault(r.dimension, []).append(r)
    assert set(by_dimension) == {"pickup_area", "dropoff_area", "route"}
    for rows in by_dimension.values():
        rows.sort(key=lambda r: r.rank_in_dimension)
        assert [r.rank_in_dimension for r in rows] == list(range(1, len(rows) + 1))
        assert rows == sorted(rows, key=lambda r: (-r.trip_count, r.area_key))
        assert sum(r.trip_count for r in rows) == planted.VALID
    top = {(r.dimension, r.area_key, r.rank_in_dimension)
           for r in marts.top_areas(valid, 3).collect()}
    assert top == {(r.dimension, r.area_key, r.rank_in_dimension)
                   for r in ranked if r.rank_in_dimension <= 3}


def test_marts_do_not_depend_on_row_order(spark, valid):
    reversed_rows = planted.landed(spark, planted.rows()[::-1]).repartition(5)
    again = rules.valid_trips(typed(reversed_rows), SETTINGS)
    for build in (lambda v: marts.trip_performance(v, SETTINGS), marts.demand_metrics,
                  marts.vendor_performance):
        assert compare(build(valid), build(again)).first().differing_rows == 0


def test_gate_names_the_kpi_and_builds_nothing(valid):
    with pytest.raises(UnapprovedThreshold, match="KPI-016"):
        marts.trip_performance(valid, BLOCKED)
    with pytest.raises(UnapprovedThreshold):
        BLOCKED.require("long_trip_seconds")
    assert gate(BLOCKED, allow_withheld=True) == ["KPI-016"]
    assert gate(SETTINGS) == []


def test_withheld_kpi_leaves_a_named_empty_column(valid):
    mart = marts.trip_performance(valid, BLOCKED, allow_withheld=True)
    assert "kpi_016_long_trip_rate_pct" not in mart.columns
    assert mart.where("kpi_016_withheld_pending_long_trip_seconds is not null").count() == 0
    assert "kpi_017_low_speed_rate_pct" in mart.columns


def test_columns_never_claim_road_distance(valid):
    columns = [c for m in (marts.trip_performance(valid, SETTINGS), marts.vendor_performance(valid))
               for c in m.columns]
    assert all("estimated" in c for c in columns if c.endswith(("_km", "_kmh")))


def test_drill_down_refuses_other_dimensions(valid):
    with pytest.raises(ValueError, match="no dimension"):
        kpis.drill_down(valid, "KPI-003", ["route"], SETTINGS)
    by_vendor = kpis.drill_down(valid, "KPI-001", ["vendor"], SETTINGS).collect()
    assert sum(r.kpi_001_total_trips for r in by_vendor) == planted.VALID


def test_presentation_rounds_decimal_ties_up(spark):
    vendors = spark.createDataFrame(
        [(1, 10, 50.125, 2403.0, 2403.0, 2403.0, 1.005, 1.25)],
        "vendor_id int, vendor_trips bigint, kpi_013_vendor_trip_share_pct double,"
        "kpi_014_avg_duration_seconds double, median_duration_seconds double,"
        "kpi_015_p90_duration_seconds double, avg_estimated_distance_km double,"
        "avg_estimated_speed_kmh double")
    row = panels.vendor_comparison(vendors).first()
    assert (row.trip_share_pct, row.avg_duration_min) == (50.13, 40.1)
    assert (row.avg_estimated_distance_km, row.avg_estimated_speed_kmh) == (1.01, 1.3)


def test_absurd_durations_stop_no_mart_and_no_profile(spark):
    values = [planted.row(i, trip_duration=str(d), **({} if i % 2 else {"vendor_id": "1"}))
              for i, d in enumerate([10**13, 2**63 - 1, 2**63 - 1, -2**63, 600, 700])]
    text = planted.landed(spark, values)
    judged = rules.evaluate(typed(text), SETTINGS)
    valid, rejected = rules.split(judged, SETTINGS)
    quality = marts.data_quality(judged, valid, rejected)
    performance, demand = marts.trip_performance(valid, SETTINGS), marts.demand_metrics(valid)
    fact, places = star.fact_trip(valid), star.dim_location(valid)
    frames = [
        performance, demand, marts.geographic_metrics(valid), marts.vendor_performance(valid), quality,
        panels.exec_tiles(valid, performance, demand, quality), kpis.rollup(valid, SETTINGS),
        profile.profile_numeric_stats(judged), profile.duration_consistency_stats(judged),
        profile.duration_iqr(judged), profile.profile_vendor(judged), profile.profile_saf(judged),
        profile.threshold_candidates(judged), dist.duration_log_stats(judged),
        dist.duration_boxplot(judged), dist.duration_histogram(judged), dist.duration_by_dim(valid),
        dist.cross_field(valid), dist.vendor_profile_full(valid, SETTINGS),
        star.trips_by_month_and_area(fact, star.dim_date(valid), star.dim_time(valid), places)]
    assert all(frame.collect() for frame in frames)


def test_drill_down_of_every_kpi(valid):
    months = kpis.drill_down(valid, "KPI-002", ["month", "weekend"], SETTINGS)
    assert {"pickup_month", "is_weekend"} <= set(months.columns) and months.count() >= 1
    for kpi_id in [f"KPI-{n:03}" for n in range(1, 18)]:
        assert kpis.drill_down(valid, kpi_id, [], SETTINGS).count() >= 1
    for kpi_id in ("KPI-018", "KPI-019", "KPI-020"):
        with pytest.raises(ValueError, match="from_data_quality"):
            kpis.drill_down(valid, kpi_id, [], SETTINGS)
