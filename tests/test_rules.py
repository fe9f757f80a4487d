from collections import Counter

import pytest

from tests import planted
from tripledger.config import Settings
from tripledger.operators import rules
from tripledger.operators.typing import typed
from tripledger.plans import marts, profile
from tripledger.plans.distributions import duplicate_types
from tripledger.sources.contract import SOURCE_COLUMNS

SETTINGS = Settings()


@pytest.fixture(scope="module")
def judged(spark):
    return rules.evaluate(typed(planted.landed(spark)), SETTINGS).cache()


def test_planted_cases_end_under_their_rule(judged):
    found = Counter(r.rule_id for r in judged.select("rule_id").collect())
    assert found == planted.expected_rules()


def test_coordinate_classes(judged):
    found = Counter(r.coordinate_anomaly for r in judged.collect())
    want = Counter()
    for case in planted.CASES:
        want[case.geo] += case.times
    assert {k: n for k, n in found.items() if k} == {k: n for k, n in want.items() if k}


def test_rejections_carry_the_reason_of_their_rule(judged):
    reasons = {r.rule_id: r.outcome for r in rules.REJECTING}
    pairs = rules.quarantined(judged).select("rule_id", "quarantine_reason").distinct().collect()
    assert pairs and all(reasons[p.rule_id] == p.quarantine_reason for p in pairs)


def test_flags_and_outliers_stay_in_the_valid_table(judged):
    valid, _ = rules.split(judged, SETTINGS)
    data = valid.collect()
    assert sum(r.is_passenger_count_anomaly for r in data) == planted.n_of("bus load", "nobody aboard")
    assert sum(r.is_store_fwd_flag_anomaly for r in data) == planted.n_of("flag lower case",
                                                                          "flag not given")
    assert sum(r.coordinate_anomaly == "GEO-005" for r in data) == planted.n_of("round trip")
    assert sum(r.is_duration_outlier for r in data) == planted.n_of("takes two days")


def test_profile_counts_each_rule_on_its_own(judged):
    failed = {r.rule_id: (r.failed_records, r.status)
              for r in profile.profile_quality(judged, SETTINGS).collect()}
    assert failed["DQ-007"] == (planted.expected_rules()["DQ-007"], "FAIL")
    assert failed["DQ-008"][0] == planted.n_of("bus load", "nobody aboard")
    assert failed["DQ-012"] == (0, "PASS")
    assert failed["DQ-014"] == (None, "POLICY")


def test_quality_mart_reconciles_and_counts_duplicates_before_rejection(judged):
    valid, rejected = rules.split(judged, SETTINGS)
    batch = marts.data_quality(judged, valid, rejected).first()
    assert (batch.total_records, batch.valid_records, batch.quarantined_records) == (
        planted.TOTAL, planted.VALID, planted.TOTAL - planted.VALID)
    repeated = planted.expected_rules()["DQ-002"]
    assert batch.duplicate_records == repeated and batch.reconciles
    assert batch.kpi_020_duplicate_rate_pct == pytest.approx(100 * repeated / planted.TOTAL, abs=5e-5)


def test_repeated_ids_by_kind(spark):
    kinds = duplicate_types(typed(planted.landed_batches(spark))).collect()
    assert {k.duplicate_type: (k.ids, k.rows) for k in kinds} == {
        name: (1, here + there) for name, (here, there, _) in planted.REPEATED.items()}


def test_same_trip_in_two_batches_and_in_one(spark):
    once, twice = [planted.row(1)], [planted.row(2), planted.row(2)]
    both = planted.landed(spark, once + twice, "a").unionAll(planted.landed(spark, once, "b"))
    kinds = {k.duplicate_type: k.rows for k in duplicate_types(typed(both)).collect()}
    assert kinds == {"A": 2, "B": 2}


def test_missing_or_malformed_cell_puts_a_row_in_exactly_one_table(spark):
    values = [planted.row(i, **{c: text}) for i, (c, text) in enumerate(
        (c, text) for c in SOURCE_COLUMNS for text in ("", " ", "n/a", "1e999", "NaN", "-1"))]
    judged = rules.evaluate(typed(planted.landed(spark, values)), SETTINGS)
    valid, rejected = rules.split(judged, SETTINGS)
    n_valid, n_rejected = valid.count(), rejected.count()
    assert n_valid + n_rejected == len(values) and n_valid and n_rejected
    assert judged.where("is_valid_trip is null").count() == 0


def test_missing_vendor_and_flag_are_decided(spark):
    values = [planted.row(1, vendor_id=""), planted.row(2, vendor_id="3"),
              planted.row(3, store_and_fwd_flag="")]
    judged = {r.id: r for r in rules.evaluate(typed(planted.landed(spark, values)),
                                              SETTINGS).collect()}
    assert judged["trip-1"].rule_id == judged["trip-2"].rule_id == "DQ-003"
    assert judged["trip-3"].is_valid_trip and judged["trip-3"].is_store_fwd_flag_anomaly


def test_very_long_duration_does_not_overflow(spark):
    values = [planted.row(1, trip_duration=str(2**63 - 1)), planted.row(2, trip_duration=str(-2**63))]
    judged = {r.id: r for r in rules.evaluate(typed(planted.landed(spark, values)),
                                              SETTINGS).collect()}
    assert judged["trip-1"].estimated_speed_kmh == 0.0 and judged["trip-1"].is_valid_trip
    assert judged["trip-2"].rule_id == "DQ-007"


def test_both_ways_to_the_valid_table_agree(spark, judged):
    direct = rules.valid_trips(typed(planted.landed(spark)), SETTINGS)
    split = rules.split(judged, SETTINGS)[0]
    assert direct.columns == split.columns
    assert direct.exceptAll(split).count() == 0 and split.exceptAll(direct).count() == 0


def test_unset_parameters_keep_the_decidable_part(spark):
    unset = Settings(vendor_domain=None, passenger_count_domain=None, nyc_bounds=None,
                     extreme_duration_seconds=None, low_speed_kmh=None)
    values = [planted.row(1, vendor_id="9"), planted.row(2, vendor_id=""),
              planted.row(3, passenger_count="9"), planted.row(4, passenger_count="0"),
              planted.row(5, pickup_latitude="55.0"), planted.row(6, pickup_latitude="95.0")]
    judged = rules.evaluate(typed(planted.landed(spark, values)), unset)
    found = {r.id[-1]: (r.rule_id, r.is_passenger_count_anomaly) for r in judged.collect()}
    assert found == {"1": (None, False), "2": ("DQ-003", False), "3": (None, False),
                     "4": (None, True), "5": (None, False), "6": ("DQ-009", False)}
    valid = rules.split(judged, unset)[0].first()
    assert valid.is_duration_outlier is None and valid.is_speed_outlier is None
    status = {r.rule_id: r.status for r in profile.profile_quality(judged, unset).collect()}
    assert status["DQ-003"] == status["DQ-009"] == "BLOCKED_PENDING_THRESHOLD"
