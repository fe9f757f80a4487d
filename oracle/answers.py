"""One DuckDB statement per registered query, where plain SQL can say it."""

from __future__ import annotations

from oracle.duck import (
    _MEASURES, _PERFORMANCE_KEYS, _RULE_NAMES, SOURCE, at, avg_micro, avg_seconds, blank, built,
    cell,
    kpi_values, pct, ratio, rule_counts, share, shown, statement, unpivot,
)

FINAL: dict[str, str] = {}

# landing ---------------------------------------------------------------------------------------
FINAL["trip_feed"] = "SELECT * EXCLUDE (h) FROM feed"
FINAL["bronze_rows"] = "SELECT " + ", ".join(
    f"nullif({c}, '') AS {c}" for c in SOURCE) + " FROM landed"
FINAL["bronze_stamp"] = """
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS without_file, CAST(0 AS BIGINT) AS without_hash,
  CAST(1 AS BIGINT) AS load_times FROM feed"""
FINAL["bronze_idempotent"] = """
SELECT count(*) AS rows_after_first, count(*) AS rows_after_second, CAST(1 AS BIGINT) AS loads
FROM feed"""
FINAL["bronze_force_replay"] = """
SELECT count(*) AS rows_after_first, 2 * count(*) AS rows_after_second, CAST(2 AS BIGINT) AS loads
FROM feed"""
FINAL["ingest_log"] = """
SELECT source_hash AS batch, count(*) AS rows,
  CAST(sum(count(*)) OVER (ORDER BY source_hash) AS BIGINT) AS rows_in_total
FROM feed GROUP BY source_hash"""
FINAL["schema_drift"] = """
SELECT 'g' || passenger_count AS folder,
  CASE count(*) % 4 WHEN 0 THEN 'PASS' WHEN 2 THEN 'FAIL' ELSE 'WARNING' END AS profile_status,
  count(*) % 4 IN (0, 3) AS in_order,
  CASE WHEN count(*) % 4 = 2 THEN 'trip_duration' ELSE '' END AS missing,
  CASE WHEN count(*) % 4 = 3 THEN 'tip' ELSE '' END AS unexpected
FROM landed GROUP BY passenger_count"""
FINAL["file_hash"] = """
SELECT DISTINCT source_hash AS batch, true AS full_length, true AS of_the_bytes FROM feed"""
FINAL["file_profile"] = """
SELECT source_hash AS batch, 'csv' AS format, 'UTF-8' AS encoding, 'none' AS compression,
  count(*) AS rows, CAST(11 AS BIGINT) AS columns, true AS header_present, true AS has_bytes
FROM feed GROUP BY source_hash"""

# typing and derivation ---------------------------------------------------------------------------
_KINDS = {"vendor_id": "INTEGER", "pickup_datetime": "TIMESTAMP", "dropoff_datetime": "TIMESTAMP",
          "passenger_count": "INTEGER", "pickup_longitude": "DOUBLE", "pickup_latitude": "DOUBLE",
          "dropoff_longitude": "DOUBLE", "dropoff_latitude": "DOUBLE", "trip_duration": "BIGINT"}
FINAL["silver_typed"] = ("SELECT nullif(trim(id), '') AS id, " + ", ".join(
    f"TRY_CAST(nullif(trim({c}), '') AS {k}) AS {c}" for c, k in _KINDS.items()) + """,
  upper(trim(store_and_fwd_flag)) AS store_and_fwd_flag_raw,
  trim(store_and_fwd_flag) AS store_and_fwd_flag_original, source_file, source_hash FROM landed""")
_CALENDAR = ("pickup_date, pickup_year, pickup_month, pickup_week, pickup_day, day_of_week,"
             " pickup_hour, is_weekend, time_of_day")
FINAL["calendar_fields"] = f"SELECT id, trip_duration_minutes, {_CALENDAR} FROM trips"
FINAL["time_of_day"] = """
SELECT time_of_day, is_weekend, count(*) AS trips FROM trips GROUP BY ALL"""
FINAL["haversine"] = "SELECT id, estimated_distance_km FROM trips"
FINAL["duration_consistency"] = """
SELECT id, trip_duration, observed_duration_seconds, duration_difference_seconds FROM trips"""
FINAL["speed"] = "SELECT id, trip_duration, estimated_speed_kmh FROM trips"
FINAL["geo_cells"] = f"""
SELECT id, {cell("pickup")} AS pickup_area, {cell("dropoff")} AS dropoff_area,
  pickup_area || ' -> ' || dropoff_area AS route_key FROM feed"""

# rules and split ---------------------------------------------------------------------------------
FINAL["id_occurrences"] = """
SELECT f.id, f.source_hash, o.n AS id_occurrences
FROM feed f LEFT JOIN occurring o ON o.id = f.id"""
FINAL["dq_evaluated"] = "SELECT id, source_hash, " + ", ".join(
    f"pass_dq_{n}" for n in _RULE_NAMES) + """,
  is_passenger_count_anomaly, is_store_fwd_flag_anomaly, coordinate_anomaly, rule_id,
  quarantine_reason, is_valid_trip FROM judged"""
FINAL["dq_rule_pass_counts"] = rule_counts("judged")
FINAL["dq_unset_params"] = rule_counts("judged_unset")
FINAL["dq_flags"] = """
SELECT count(*) AS valid_rows,
  count(*) FILTER (is_passenger_count_anomaly) AS is_passenger_count_anomaly,
  count(*) FILTER (is_store_fwd_flag_anomaly) AS is_store_fwd_flag_anomaly FROM valid"""
FINAL["geo_anomaly_class"] = """
SELECT coordinate_anomaly, count(*) AS rows, count(*) FILTER (is_valid_trip) AS valid_rows
FROM judged GROUP BY coordinate_anomaly"""
_TRIP = ("id, vendor_id, pickup_datetime, dropoff_datetime, passenger_count, pickup_longitude,"
         " pickup_latitude, dropoff_longitude, dropoff_latitude, store_and_fwd_flag, trip_duration")
FINAL["silver_trips"] = f"""
SELECT {_TRIP}, trip_duration_minutes, {_CALENDAR}, estimated_distance_km, estimated_speed_kmh,
  observed_duration_seconds, duration_difference_seconds, pickup_area, dropoff_area, route_key,
  is_passenger_count_anomaly, is_store_fwd_flag_anomaly, coordinate_anomaly,
  is_duration_outlier, is_speed_outlier, is_valid_trip, source_file, source_hash FROM valid"""
FINAL["quarantine"] = f"""
SELECT {_TRIP}, estimated_distance_km, estimated_speed_kmh, rule_id, quarantine_reason,
  coordinate_anomaly, source_file, source_hash FROM rejected"""
FINAL["outlier_flags"] = "SELECT id, is_duration_outlier, is_speed_outlier FROM valid"
FINAL["audit_overlap"] = """
SELECT id FROM valid WHERE id IN (SELECT id FROM rejected WHERE id IS NOT NULL)"""

# marts -------------------------------------------------------------------------------------------
FINAL["trip_performance"] = "SELECT * FROM performance"
FINAL["trip_perf_withheld"] = "SELECT * FROM performance_unset"
FINAL["demand_metrics"] = "SELECT * FROM demand"
FINAL["geographic_metrics"] = "SELECT * FROM ranked"
FINAL["vendor_performance"] = "SELECT * FROM vendors"
FINAL["data_quality"] = "SELECT * FROM quality"
_SCORES = ("completeness_score_pct", "uniqueness_score_pct", "validity_score_pct",
           "consistency_score_pct", "geographic_validity_score_pct")
FINAL["dq_component_scores"] = f"SELECT source_hash, {', '.join(_SCORES)} FROM quality"
FINAL["gold_idempotent"] = " UNION ALL ".join(
    f"SELECT '{mart}' AS mart, count(*) AS rows, CAST(0 AS BIGINT) AS differing_rows FROM {step}"
    for mart, step in (("trip_performance", "performance"), ("demand_metrics", "demand"),
                       ("geographic_metrics", "ranked"), ("vendor_performance", "vendors"),
                       ("data_quality", "quality")))

_PERFORMANCE = {
    1: "kpi_001_total_trips", 2: "kpi_002_avg_duration_seconds, kpi_002_avg_duration_minutes",
    3: "kpi_003_median_duration_seconds, kpi_003_median_duration_minutes",
    4: "kpi_004_p90_duration_seconds, kpi_004_p90_duration_minutes",
    5: "kpi_005_avg_estimated_distance_km", 6: "kpi_006_avg_estimated_speed_kmh",
    16: "kpi_016_long_trip_rate_pct", 17: "kpi_017_low_speed_rate_pct"}
for _n, _columns in _PERFORMANCE.items():
    FINAL[f"kpi_{_n:03}"] = f"SELECT {_PERFORMANCE_KEYS}, {_columns} FROM performance"
FINAL["kpi_007"] = "SELECT pickup_date, day_trips AS kpi_007_trips_per_day FROM peaks"
FINAL["kpi_008"] = """
SELECT pickup_date, pickup_hour, vendor_id, day_of_week, kpi_008_trips_per_hour FROM demand"""
FINAL["kpi_009"] = """
SELECT pickup_date, peak_hour AS kpi_009_peak_hour, peak_trips AS kpi_009_peak_hour_trip_count
FROM peaks"""
for _n, _dimension in ((10, "pickup_area"), (11, "dropoff_area")):
    FINAL[f"kpi_{_n:03}"] = f"""
SELECT dimension, area_key, trip_count FROM ranked
WHERE rank_in_dimension = 1 AND dimension = '{_dimension}'"""
FINAL["kpi_012"] = """
SELECT * EXCLUDE (rank_in_dimension) FROM ranked
WHERE rank_in_dimension = 1 AND dimension = 'route'"""
FINAL["kpi_013"] = """
SELECT vendor_id, vendor_trips, total_trips, kpi_013_vendor_trip_share_pct FROM vendors"""
FINAL["kpi_014"] = """
SELECT vendor_id, kpi_014_avg_duration_seconds, kpi_014_avg_duration_minutes FROM vendors"""
FINAL["kpi_015"] = """
SELECT vendor_id, kpi_015_p90_duration_seconds, kpi_015_p90_duration_minutes,
  median_duration_seconds, avg_estimated_distance_km, avg_estimated_speed_kmh FROM vendors"""
for _n, _count, _rate in ((18, "valid_records", "kpi_018_data_quality_score_pct"),
                          (19, "quarantined_records", "kpi_019_invalid_record_rate_pct"),
                          (20, "duplicate_records", "kpi_020_duplicate_rate_pct")):
    FINAL[f"kpi_{_n:03}"] = f"SELECT source_hash, total_records, {_count}, {_rate} FROM quality"
FINAL["kpi_by_dims"] = f"""
SELECT pickup_hour, vendor_id, {at("trip_duration", 0.9)} AS kpi_004_p90_duration_seconds,
  {at("trip_duration", 0.9, 4, "60")} AS kpi_004_p90_duration_minutes
FROM valid GROUP BY pickup_hour, vendor_id"""
FINAL["kpi_by_area"] = f"""
SELECT pickup_area, vendor_id, {avg_micro("km_u")} AS kpi_005_avg_estimated_distance_km
FROM valid GROUP BY pickup_area, vendor_id"""
FINAL["kpi_per_day_by_part"] = """
SELECT pickup_date, time_of_day, vendor_id, count(*) AS kpi_007_trips_per_day
FROM valid GROUP BY ALL"""
FINAL["kpi_rollup"] = f"""
SELECT CAST(dayofweek(pickup_date) + 1 AS INTEGER) AS weekday, time_of_day, vendor_id,
  CAST(grouping_id(CAST(dayofweek(pickup_date) + 1 AS INTEGER), time_of_day, vendor_id)
       AS INTEGER) AS grain, {kpi_values()}
FROM valid
GROUP BY CUBE (CAST(dayofweek(pickup_date) + 1 AS INTEGER), time_of_day, vendor_id)"""

# panels ------------------------------------------------------------------------------------------
FINAL["exec_tiles"] = "SELECT * FROM tiles"
FINAL["demand_trend"] = "SELECT * FROM trend"
FINAL["daily_trend"] = "SELECT pickup_date, day_trips AS trips_per_day FROM peaks"
FINAL["hour_profile"] = """
SELECT pickup_hour, CAST(sum(n) AS BIGINT) AS trips FROM hours GROUP BY pickup_hour"""
_BEST = f"""
SELECT dimension, area_key, trip_count,
  {shown("avg_duration_seconds", 1, 4, 60)} AS avg_duration_min,
  {shown("median_duration_seconds", 1, 4, 60)} AS median_duration_min,
  {shown("p90_duration_seconds", 1, 4, 60)} AS p90_duration_min,
  {shown("avg_estimated_distance_km", 2, 6)} AS avg_estimated_distance_km,
  {shown("avg_estimated_speed_kmh", 1, 6)} AS avg_estimated_speed_kmh, rank_in_dimension
FROM ranked WHERE rank_in_dimension <= 10"""
FINAL["top_areas_routes"] = _BEST
FINAL["top_pickup_areas"] = _BEST + " AND dimension = 'pickup_area'"
FINAL["vendor_comparison"] = f"""
SELECT vendor_id, vendor_trips, {shown("kpi_013_vendor_trip_share_pct", 2)} AS trip_share_pct,
  {shown("kpi_014_avg_duration_seconds", 1, 4, 60)} AS avg_duration_min,
  {shown("median_duration_seconds", 1, 4, 60)} AS median_duration_min,
  {shown("kpi_015_p90_duration_seconds", 1, 4, 60)} AS p90_duration_min,
  {shown("avg_estimated_distance_km", 2, 6)} AS avg_estimated_distance_km,
  {shown("avg_estimated_speed_kmh", 1, 6)} AS avg_estimated_speed_kmh
FROM vendors"""
FINAL["dq_panel"] = f"""
SELECT source_hash, source_file, total_records, valid_records, quarantined_records,
  duplicate_records,
  {shown("kpi_018_data_quality_score_pct", 3)} AS kpi_018_quality_score_pct,
  {shown("kpi_019_invalid_record_rate_pct", 3)} AS kpi_019_invalid_rate_pct,
  {shown("kpi_020_duplicate_rate_pct", 3)} AS kpi_020_duplicate_rate_pct,
  {shown("completeness_score_pct", 3)} AS completeness_pct,
  {shown("uniqueness_score_pct", 3)} AS uniqueness_pct,
  {shown("validity_score_pct", 3)} AS validity_pct,
  {shown("consistency_score_pct", 3)} AS consistency_pct,
  {shown("geographic_validity_score_pct", 3)} AS geographic_validity_pct, reconciles
FROM quality"""
FINAL["quarantine_breakdown"] = f"""
SELECT rule_id, quarantine_reason, count(*) AS rejected_rows,
  {pct("count(*)", "any_value(total)")} AS pct_of_batch
FROM rejected, (SELECT count(*) AS total FROM feed) GROUP BY rule_id, quarantine_reason"""
FINAL["panel_agreement"] = """
SELECT (SELECT kpi_001_total_trips FROM tiles) AS tile_trips,
  (SELECT CAST(sum(trips_per_hour) AS BIGINT) FROM trend) AS trend_trips,
  (SELECT count(*) FROM valid) AS valid_rows,
  (SELECT count(*) = any_value(t.kpi_001_total_trips) FROM valid, tiles t) AND
  (SELECT sum(trips_per_hour) FROM trend) = (SELECT count(*) FROM valid) AS agrees"""

# profiling ---------------------------------------------------------------------------------------
FINAL["profile_run"] = """
SELECT 'PROFILE_CHECK' AS profiling_run_id, TIMESTAMP '2024-01-02' AS profiling_timestamp,
  min(source_file) AS source_file,
  min(source_hash) AS source_hash, count(*) AS row_count, CAST(13 AS INTEGER) AS column_count,
  count(DISTINCT source_hash) AS batches, 'PASS' AS profile_status FROM landed"""
FINAL["profile_schema"] = unpivot([
    f"'{c}' AS column_name, {c} AS null_count, {share(c, 'total')} AS null_rate,"
    f" CASE WHEN {c} = 0 THEN 'PASS' ELSE 'INVESTIGATE' END AS status" for c in SOURCE], "blanks")
FINAL["profile_uniqueness"] = f"""
SELECT i.*, r.exact_duplicate_rows, {pct("i.duplicate_rows", "b.total")} AS duplicate_rate
FROM id_copies i, row_copies r, blanks b"""
FINAL["profile_exact_dups"] = "SELECT * FROM row_copies"
FINAL["profile_domain_stats"] = f"""
SELECT column_name, value, count, {share("count", "(SELECT total FROM blanks)")} AS percentage
FROM domains
QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value NULLS FIRST) <= 25"""
FINAL["duration_consistency_stats"] = f"""
SELECT min(pickup_date) AS min_date, max(pickup_date) AS max_date,
  count(DISTINCT pickup_date) AS dates,
  count(*) FILTER (duration_difference_seconds = 0) AS exact_match,
  count(*) FILTER (duration_difference_seconds <> 0) AS mismatch,
  min(duration_difference_seconds) AS min_diff, max(duration_difference_seconds) AS max_diff,
  {ratio("sum(duration_difference_seconds)", "count(duration_difference_seconds)", 4)} AS mean_diff,
  {at("duration_difference_seconds", 0.5)} AS median_diff FROM trips"""
FINAL["profile_by_hour"] = "SELECT pickup_hour, count(*) AS trips FROM trips GROUP BY pickup_hour"
FINAL["profile_by_dow"] = "SELECT day_of_week, count(*) AS trips FROM trips GROUP BY day_of_week"
FINAL["profile_geo"] = f"""
SELECT r.*, g.geo_001, g.geo_002, g.geo_003, g.geo_at_origin, g.geo_005
FROM (SELECT min(pickup_latitude) AS plat_min, max(pickup_latitude) AS plat_max,
        min(pickup_longitude) AS plon_min, max(pickup_longitude) AS plon_max,
        {at("pickup_latitude", 0.01, 9)} AS plat_p1, {at("pickup_latitude", 0.99, 9)} AS plat_p99,
        {at("pickup_longitude", 0.01, 9)} AS plon_p1, {at("pickup_longitude", 0.99, 9)} AS plon_p99
      FROM trips) r, geo_counts g"""
FINAL["profile_numeric_stats"] = "SELECT * FROM numeric"
FINAL["profile_anomalies"] = unpivot([
    f"'{kind}' AS anomaly_type, {c} AS record_count, {share(c, 'total')} AS percentage,"
    f" '{severity}' AS severity, '{action}' AS recommended_action"
    for kind, c, severity, action in (
        ("GEO-001", "geo_001", "high", "QUARANTINE"), ("GEO-002", "geo_002", "high", "QUARANTINE"),
        ("GEO-003", "geo_003", "high", "QUARANTINE"),
        ("GEO-005", "geo_005", "medium", "KEEP_AND_REVIEW"),
        ("ZERO_DURATION", "zero_duration", "critical", "QUARANTINE"),
        ("NEGATIVE_DURATION", "negative_duration", "critical", "QUARANTINE"),
        ("ZERO_DISTANCE", "zero_distance", "medium", "KEEP_AND_REVIEW"))], "geo_counts")
FINAL["duration_extras"] = """
SELECT zero_duration AS zero, negative_duration AS negative, null_duration AS null_count,
  zero_distance FROM geo_counts"""
FINAL["duration_iqr"] = """
SELECT round(p25, 4) AS p25, round(p75, 4) AS p75, round(p75 - p25, 4) AS iqr,
  round(p75 + (p75 - p25) * 1.5, 4) AS upper
FROM (SELECT quantile_cont(trip_duration, 0.25) AS p25, quantile_cont(trip_duration, 0.75) AS p75
      FROM trips)"""
_SPREAD = ", ".join(f"{at('trip_duration', p)} AS {n}"
                    for n, p in (("p50", 0.5), ("p90", 0.9), ("p95", 0.95)))
FINAL["profile_vendor"] = f"""
SELECT vendor_id, count(*) AS n, {avg_seconds()} AS avg_dur, {_SPREAD},
  {avg_micro("km_u")} AS avg_dist, {avg_micro("kmh_u")} AS avg_speed
FROM trips GROUP BY vendor_id"""
FINAL["profile_saf"] = f"""
SELECT upper(trim(store_and_fwd_flag)) AS flag, count(*) AS n, {avg_seconds()} AS avg_dur,
  {at("trip_duration", 0.5)} AS p50, {at("trip_duration", 0.9)} AS p90,
  {share("count(*)", "(sum(count(*)) OVER ())")} AS percentage
FROM trips GROUP BY upper(trim(store_and_fwd_flag))"""
FINAL["profile_quality"] = " UNION ALL ".join(
    f"SELECT 'DQ-{n}' AS rule_id, '{name}' AS rule_name, count(*) AS total_records,"
    f" count(*) FILTER (NOT pass_dq_{n}) AS failed_records,"
    f" {share(f'count(*) FILTER (NOT pass_dq_{n})', 'count(*)')} AS failure_rate,"
    f" CASE WHEN bool_and(pass_dq_{n}) THEN 'PASS' ELSE 'FAIL' END AS status FROM judged"
    for n, (name, _) in _RULE_NAMES.items()) + "".join(
    f" UNION ALL SELECT 'DQ-{n}', '{name}', count(*), NULL, NULL, 'POLICY' FROM judged"
    for n, name in (("014", "outliers_flagged_never_deleted"), ("015", "rejections_are_auditable")))
_GAPS = "greatest(b.total - b.id - b.pickup_datetime - b.dropoff_datetime, 0)"
FINAL["profile_component_scores"] = f"""
SELECT {pct(_GAPS, "b.total")} AS completeness,
  {pct("(b.total - i.duplicate_rows)", "b.total")} AS uniqueness,
  {pct("(b.total - g.mismatch)", "b.total")} AS consistency,
  {pct("(b.total - g.geo_001 - g.geo_at_origin)", "b.total")} AS geographic_validity
FROM blanks b, id_copies i, geo_counts g"""
_MEASURE_COLUMNS = {name: column for name, column, _, _ in _MEASURES}


def _candidate(threshold: str, blocks: str, letter: str, method: str, measure: str, side: str,
               value: str) -> str:
    counted = f"(SELECT count(*) FROM trips WHERE {_MEASURE_COLUMNS[measure]} {side} value)"
    return (f"SELECT '{threshold}' AS threshold, '{blocks}' AS blocks, '{letter}' AS candidate,"
            f" '{method}' AS method, CAST({value} AS DOUBLE) AS value,"
            f" {counted} AS flagged_rows,"
            f" {share(counted, '(SELECT count(*) FROM trips)')} AS flagged_pct"
            f" FROM numeric WHERE column_name = '{measure}'")


FINAL["threshold_candidates"] = " UNION ALL ".join(_candidate(*c) for c in (
    ("long_trip_seconds", "KPI-016", "A", "percentile P95", "duration", ">", "p95"),
    ("long_trip_seconds", "KPI-016", "B", "percentile P99", "duration", ">", "p99"),
    ("long_trip_seconds", "KPI-016", "C", "business", "duration", ">", "3600"),
    ("low_speed_kmh", "KPI-017", "A", "percentile P25", "speed", "<", "p25"),
    ("low_speed_kmh", "KPI-017", "B", "quarter of median", "speed", "<", "round(p50 * 0.25, 9)"),
    ("low_speed_kmh", "KPI-017", "C", "business", "speed", "<", "5"),
    ("extreme_duration_seconds", "is_duration_outlier", "A", "percentile P99.9", "duration", ">",
     "p999"),
    ("extreme_duration_seconds", "is_duration_outlier", "B", "IQR", "duration", ">",
     "round(p75 + (p75 - p25) * 1.5, 9)"),
    ("extreme_duration_seconds", "is_duration_outlier", "C", "business", "duration", ">", "86400"),
    ("extreme_distance_km", "GEO-006", "A", "percentile P99.9", "distance", ">", "p999"),
    ("extreme_distance_km", "GEO-006", "B", "business", "distance", ">", "100")))
_SPARK_KINDS = {"id": "string", "store_and_fwd_flag": "string", "trip_duration": "bigint",
                "vendor_id": "int", "passenger_count": "int", "pickup_datetime": "timestamp_ntz",
                "dropoff_datetime": "timestamp_ntz"}
FINAL["profile_schema_full"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{_SPARK_KINDS.get(c, 'double')}' AS data_type,"
    f" false AS nullable, count(DISTINCT nullif(trim({c}), '')) AS distinct_count,"
    f" count(*) FILTER ({blank(c)}) AS null_count,"
    f" {share(f'count(*) FILTER ({blank(c)})', 'count(*)')} AS null_rate FROM landed"
    for c in SOURCE)
FINAL["duplicate_types"] = f"""
SELECT duplicate_type, count(*) AS ids, CAST(sum(n) AS BIGINT) AS rows,
  {pct("sum(n)", "(SELECT count(*) FROM feed)")} AS rate
FROM (SELECT id, count(*) AS n,
        CASE WHEN count(DISTINCT payload) > 1 THEN 'C'
             WHEN count(DISTINCT source_hash) > 1 THEN 'B' ELSE 'A' END AS duplicate_type
      FROM (SELECT id, source_hash, {{'a': vendor_id, 'b': pickup_datetime, 'c': dropoff_datetime,
              'd': passenger_count, 'e': pickup_longitude, 'f': pickup_latitude,
              'g': dropoff_longitude, 'h': dropoff_latitude, 'i': store_and_fwd_flag,
              'j': trip_duration}} AS payload
            FROM feed WHERE id IS NOT NULL)
      GROUP BY id HAVING count(*) > 1)
GROUP BY duplicate_type"""
FINAL["geo_006"] = """
SELECT id, source_hash, estimated_distance_km, coordinate_anomaly, is_valid_trip,
  'GEO-006' AS distance_anomaly FROM judged WHERE estimated_distance_km > 100"""
FINAL["speed_class"] = """
SELECT CASE WHEN coordinate_anomaly IN ('GEO-001', 'GEO-002', 'GEO-003', 'GEO-004') THEN 'SPEED-004'
            WHEN trip_duration IS NULL OR trip_duration <= 0 OR trip_duration > 86400
              THEN 'SPEED-005'
            WHEN km_u = 0 THEN 'SPEED-001'
            WHEN estimated_speed_kmh < 5 THEN 'SPEED-002'
            WHEN estimated_speed_kmh > 120 THEN 'SPEED-003' ELSE 'NORMAL' END AS speed_class,
  count(*) AS trips, count(*) FILTER (is_valid_trip) AS valid_trips
FROM judged GROUP BY 1"""
FINAL["duration_class"] = f"""
SELECT CASE WHEN trip_duration IS NULL OR trip_duration <= 0 THEN 'INVALID'
            WHEN trip_duration > 86400 THEN 'EXTREME_REVIEW'
            WHEN trip_duration > 3600 THEN 'LONG_BUT_PLAUSIBLE' ELSE 'NORMAL' END
    AS duration_class, count(*) AS trips,
  {share("count(*)", "(sum(count(*)) OVER ())")} AS percentage
FROM trips GROUP BY 1"""
FINAL["duration_log_stats"] = """
SELECT count(*) AS n, round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean,
  round(stddev_samp(x), 6) AS stddev, """ + ", ".join(
    f"round(quantile_cont(x, {p}), 6) AS {n}" for n, p in (
        ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))
) + " FROM positive"
FINAL["duration_histogram"] = """
SELECT CAST(floor(trip_duration / 300) AS BIGINT) * 300 AS bin_start, count(*) AS trips
FROM trips WHERE trip_duration IS NOT NULL GROUP BY 1"""
FINAL["duration_boxplot"] = """
SELECT min(trip_duration) FILTER (inside) AS lower_whisker, round(any_value(q1), 4) AS q1,
  round(any_value(q2), 4) AS median, round(any_value(q3), 4) AS q3,
  max(trip_duration) FILTER (inside) AS upper_whisker, count(*) FILTER (NOT inside) AS outliers
FROM (SELECT *, trip_duration BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
      FROM positive, (SELECT quantile_cont(trip_duration, 0.25) AS q1,
                        quantile_cont(trip_duration, 0.5) AS q2,
                        quantile_cont(trip_duration, 0.75) AS q3 FROM positive))"""
_BY = {"hour": "pickup_hour", "weekday": "day_of_week", "time_of_day": "time_of_day",
       "vendor": "vendor_id"}
FINAL["duration_by_dim"] = " UNION ALL ".join(f"""
SELECT '{name}' AS dimension, CAST({column} AS VARCHAR) AS value, count(*) AS trips,
  {avg_seconds()} AS avg_duration_seconds, {at("trip_duration", 0.5)} AS p50_duration_seconds,
  {at("trip_duration", 0.9)} AS p90_duration_seconds,
  {at("trip_duration", 0.95)} AS p95_duration_seconds
FROM valid GROUP BY {column}""" for name, column in _BY.items())
_DEMAND = {"date": "CAST(pickup_date AS VARCHAR)",
           "hour": "lpad(CAST(pickup_hour AS VARCHAR), 2, '0')", "weekday": "day_of_week",
           "month": "strftime(pickup_date, '%Y-%m')", "time_of_day": "time_of_day",
           "weekend": "CASE WHEN is_weekend THEN 'weekend' ELSE 'weekday' END"}
FINAL["demand_profile"] = """
SELECT dimension, value, trips,
  row_number() OVER (PARTITION BY dimension ORDER BY trips DESC, value) = 1 AS is_max,
  row_number() OVER (PARTITION BY dimension ORDER BY trips, value) = 1 AS is_min
FROM (""" + " UNION ALL ".join(
    f"SELECT '{name}' AS dimension, {e} AS value, count(*) AS trips FROM valid GROUP BY {e}"
    for name, e in _DEMAND.items()) + ")"
FINAL["coord_profile"] = " UNION ALL ".join(f"""
SELECT '{c}' AS coordinate, count(*) FILTER ({c} IS NULL) AS null_count, min({c}) AS min,
  {at(c, 0.01, 9)} AS p1, {at(c, 0.25, 9)} AS p25, {at(c, 0.5, 9)} AS p50,
  {at(c, 0.75, 9)} AS p75, {at(c, 0.99, 9)} AS p99, max({c}) AS max,
  count(DISTINCT {c}) AS distinct_count,
  (SELECT {c} FROM trips WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)
    AS common_value,
  (SELECT count(*) FROM trips WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1)
    AS common_count
FROM trips""" for c in ("pickup_latitude", "pickup_longitude", "dropoff_latitude",
                        "dropoff_longitude"))
FINAL["cross_field"] = f"""
SELECT count(*) AS trips, round(corr(estimated_distance_km, trip_duration), 6) AS correlation,
  any_value(distance_p5) AS distance_p5, any_value(distance_p95) AS distance_p95,
  any_value(duration_p5) AS duration_p5, any_value(duration_p95) AS duration_p95,
  count(*) FILTER (estimated_distance_km <= distance_p5 AND trip_duration >= duration_p95)
    AS short_distance_long_duration,
  count(*) FILTER (estimated_distance_km >= distance_p95 AND trip_duration <= duration_p5)
    AS long_distance_short_duration
FROM valid, (SELECT {at("km_u", 0.05, 9, "1000000")} AS distance_p5,
               {at("km_u", 0.95, 9, "1000000")} AS distance_p95,
               {at("trip_duration", 0.05, 9)} AS duration_p5,
               {at("trip_duration", 0.95, 9)} AS duration_p95 FROM valid)"""
FINAL["vendor_profile_full"] = f"""
SELECT vendor_id, count(*) AS trip_count, {pct("count(*)", "sum(count(*)) OVER ()")} AS trip_share,
  {avg_seconds()} AS avg_duration, {at("trip_duration", 0.5)} AS median_duration,
  {at("trip_duration", 0.9)} AS p90_duration, {at("trip_duration", 0.95)} AS p95_duration,
  {avg_micro("km_u")} AS avg_distance, {at("km_u", 0.5, 9, "1000000")} AS median_distance,
  {avg_micro("kmh_u")} AS avg_speed,
  {pct("count(*) FILTER (trip_duration > 3600)", "count(*)")} AS long_trip_rate
FROM valid GROUP BY vendor_id"""
FINAL["passenger_profile"] = f"""
SELECT min(passenger_count) AS min, max(passenger_count) AS max,
  {ratio("sum(passenger_count)", "count(passenger_count)", 6)} AS mean,
  {at("passenger_count", 0.5)} AS median, count(DISTINCT passenger_count) AS distinct_count,
  count(*) FILTER (passenger_count = 0) AS zero_count,
  count(*) FILTER (passenger_count < 0) AS negative_count,
  count(*) FILTER (passenger_count IS NULL) AS null_count FROM trips"""
_FAR = "count(*) FILTER (estimated_distance_km > 100)"
_STILL = "count(*) FILTER (km_u = 0)"
FINAL["distance_rates"] = f"""
SELECT count(km_u) AS with_distance, {_STILL} AS zero_distance, {_FAR} AS extreme_distance,
  {pct(_STILL, "count(km_u)")} AS zero_distance_rate,
  {pct(_FAR, "count(km_u)")} AS extreme_distance_rate FROM trips"""
FINAL["valid_rate_drift"] = f"""
SELECT run_number, source_hash, total_records, valid_records,
  {pct("valid_records", "total_records")} AS valid_rate_pct,
  lag(valid_records) OVER w AS previous_valid_records,
  valid_records - lag(valid_records) OVER w AS valid_records_change,
  coalesce(valid_records <> lag(valid_records) OVER w, false) AS drifted
FROM (SELECT CAST(1 AS INTEGER) AS run_number, * FROM quality_unset
      UNION ALL SELECT 2 AS run_number, * FROM quality)
WINDOW w AS (PARTITION BY source_hash ORDER BY run_number)"""
FINAL["star_schema"] = """
SELECT pickup_year AS year, pickup_month AS month, time_of_day, pickup_area, count(*) AS trips,
  CAST(sum(trip_duration) AS BIGINT) AS seconds FROM valid GROUP BY ALL"""
FINAL["star_sizes"] = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count({e}) AS rows FROM {source}" for t, e, source in (
        ("fact_trip", "*", "valid"), ("dim_date", "DISTINCT pickup_date", "valid"),
        ("dim_time", "DISTINCT pickup_hour", "valid"), ("dim_vendor", "DISTINCT vendor_id", "valid"),
        ("dim_location", "DISTINCT area", "(SELECT pickup_area AS area FROM valid UNION ALL"
         " SELECT dropoff_area AS area FROM valid)"),
        ("dim_route", "DISTINCT route_key", "valid")))

# checks ------------------------------------------------------------------------------------------


def _offences(checks: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS \"check\", count(*) AS offending_rows FROM {q}"
                              for name, q in checks.items())


def _repeated(column: str, step: str) -> str:
    return (f"(SELECT {column} FROM {step} WHERE {column} IS NOT NULL GROUP BY {column}"
            " HAVING count(*) > 1)")


FINAL["expect_not_null"] = _offences({
    "silver_trips.id": "valid WHERE id IS NULL",
    "silver_trips.trip_duration": "valid WHERE trip_duration IS NULL",
    "quarantine.rule_id": "rejected WHERE rule_id IS NULL",
    "trip_performance.kpi_001_total_trips": "performance WHERE kpi_001_total_trips IS NULL",
    "geographic_metrics.dimension": "areas WHERE dimension IS NULL",
    "vendor_performance.vendor_id": "vendors WHERE vendor_id IS NULL",
    "data_quality.source_hash": "quality WHERE source_hash IS NULL",
    "silver_typed.id": "feed WHERE id IS NULL"})
FINAL["expect_unique"] = _offences({
    "silver_trips.id": _repeated("id", "valid"),
    "vendor_performance.vendor_id": _repeated("vendor_id", "vendors"),
    "data_quality.source_hash": _repeated("source_hash", "quality"),
    "silver_typed.id": _repeated("id", "feed")})
FINAL["expect_accepted"] = _offences({
    "quarantine.rule_id": "rejected WHERE rule_id NOT LIKE 'DQ-0%' OR rule_id IN ('DQ-008', 'DQ-011')",
    "demand_metrics.kpi_009_peak_hour": "demand WHERE kpi_009_peak_hour NOT BETWEEN 0 AND 23",
    "geographic_metrics.dimension":
        "areas WHERE dimension NOT IN ('pickup_area', 'dropoff_area', 'route')",
    "data_quality.reconciles": "quality WHERE NOT reconciles",
    "silver_typed.vendor_id": "feed WHERE vendor_id NOT IN (1, 2)"})
FINAL["assert_duration_positive"] = """
SELECT id, trip_duration FROM valid WHERE coalesce(trip_duration, 0) <= 0"""
FINAL["assert_non_negative"] = """
SELECT id, estimated_distance_km, estimated_speed_kmh FROM valid
WHERE least(estimated_distance_km, estimated_speed_kmh) < 0"""
FINAL["assert_has_reason"] = """
SELECT id, rule_id, quarantine_reason FROM rejected WHERE rule_id || quarantine_reason IS NULL"""
FINAL["assert_reconciliation"] = """
SELECT source_hash, total_records, valid_records, quarantined_records FROM quality
WHERE NOT reconciles"""
FINAL["assert_share_100"] = """
SELECT * FROM (SELECT round(sum(kpi_013_vendor_trip_share_pct), 4) AS total_share FROM vendors)
WHERE abs(total_share - 100) > 0.01"""
FINAL["assert_outliers_kept"] = """
SELECT (SELECT count(*) FROM judged WHERE is_valid_trip AND trip_duration > 86400)
    AS extreme_before,
  (SELECT count(*) FROM valid WHERE is_duration_outlier) AS extreme_kept"""

FINAL["can_fail_duration"] = """
SELECT id, trip_duration FROM judged WHERE coalesce(trip_duration, 0) <= 0"""
FINAL["can_fail_negative"] = """
SELECT id, -estimated_distance_km AS estimated_distance_km, estimated_speed_kmh FROM valid
WHERE estimated_distance_km > 0"""
FINAL["can_fail_reason"] = """
SELECT id, rule_id, quarantine_reason FROM judged WHERE rule_id IS NULL"""
FINAL["can_fail_reconciliation"] = """
SELECT source_hash, total_records, CAST(0 AS BIGINT) AS valid_records, quarantined_records
FROM quality WHERE source_hash <> 'batch_a' AND valid_records > 0"""
FINAL["can_fail_share"] = """
SELECT round(sum(kpi_013_vendor_trip_share_pct), 4) AS total_share FROM vendors WHERE vendor_id = 1"""
FINAL["can_fail_overlap"] = """
SELECT id FROM feed WHERE id IN (SELECT id FROM rejected WHERE id IS NOT NULL)"""
FINAL["profile_tables"] = """
SELECT "table", profiling_run_id, CASE WHEN "table" = 'profile_domain_stats'
    THEN (SELECT count(*) FROM (SELECT row_number() OVER (PARTITION BY column_name) AS place
                                FROM domains) WHERE place <= 25) ELSE rows END AS rows
FROM (VALUES ('profile_run', 1), ('profile_schema', 11), ('profile_numeric_stats', 3),
  ('profile_domain_stats', 0), ('profile_quality', 15), ('profile_anomalies', 7)) AS t("table", rows),
  (VALUES ('RUN_1'), ('RUN_2')) AS r(profiling_run_id)"""

# The same tables from landing text: what the whole build stores.
_BUILT = {"silver_trips": "silver_trips", "silver_trips_quarantine": "quarantine",
          **{mart: mart for mart in ("trip_performance", "demand_metrics", "geographic_metrics",
                                     "vendor_performance", "data_quality")}}
ANSWERS = {name: built(final) if name == "gold_idempotent" else statement(final)
           for name, final in FINAL.items()}
ANSWERS |= {f"build_{table}": built(FINAL[query]) for table, query in _BUILT.items()}
