"""The same answers as DuckDB SQL over the same input tables, one statement per query.

Each statement is a chain of named steps; a query lists the step it selects from and the chain
brings in what that step needs. Rounding is whole-number half-up on both sides.
"""

from __future__ import annotations

import re


def ratio(num: str, den: str, places: int) -> str:
    power = 10**places
    return (f"(sign({num}) * CAST((2 * {power} * abs({num}) + ({den})) // nullif(2 * ({den}), 0)"
            f" AS DOUBLE) / CAST({power} AS DOUBLE))")


def pct(part: str, whole: str, places: int = 4) -> str:
    return ratio(f"(100 * CAST({part} AS HUGEINT))", f"CAST({whole} AS HUGEINT)", places)


def shown(value: str, places: int, stored: int = 4, divisor: int = 1) -> str:
    power = 10**stored
    return ratio(f"CAST(round({value} * {power}) AS HUGEINT)", f"{divisor * power}", places)


def share(part: str, whole: str) -> str:
    return f"CAST(100 AS DOUBLE) * {part} / {whole}"


def first(default: str, *branches: tuple[int, str]) -> str:
    tests = " ".join(f"WHEN h % {prime} = 0 THEN {value}" for prime, value in branches)
    return f"CASE {tests} ELSE {default} END"


def point(origin: int, factor: int, span: int) -> str:
    return f"({origin} + ((h * {factor}) % {span}) * 2) / CAST(1000000 AS DOUBLE)"


SOURCE = ["id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
          "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
          "store_and_fwd_flag", "trip_duration"]

STEPS: dict[str, str] = {}

STEPS["mixed"] = """
SELECT *, CAST((l_orderkey * 7919 + l_partkey * 104729 + CAST(l_linenumber AS BIGINT) * 1299709)
               % 1000003 AS BIGINT) AS h
FROM lineitem"""

STEPS["starts"] = f"""
SELECT h, l_linenumber, l_returnflag,
  CASE WHEN h % 997 = 0 THEN NULL
       ELSE 'id' || l_orderkey || '-' || l_linenumber || '-' || (l_partkey % 4) END AS id,
  CAST({first("1 + l_suppkey % 2", (991, "NULL"), (983, "3"))} AS INTEGER) AS vendor_id,
  CASE WHEN h % 977 <> 0 THEN l_shipdate + to_seconds(h % 86400) END AS pickup_datetime,
  CAST({first("60 + (h * 31) % 4200", (971, "0"), (967, "-45"), (499, "90000"))} AS BIGINT)
    AS trip_duration,
  {first(point(40600001, 13, 150000), (953, "0.0"), (941, "NULL"), (929, "42.0"),
     (853, "95.0"))}
    AS pickup_latitude,
  {first(point(-74049999, 17, 125000), (953, "0.0"))} AS pickup_longitude,
  CASE WHEN l_orderkey % 2 = 0 THEN 'batch_a' ELSE 'batch_b' END AS source_hash
FROM mixed"""

STEPS["feed"] = f"""
SELECT h, id, vendor_id, CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime,
  CAST({first("pickup_datetime + to_seconds(trip_duration)", (907, "NULL"),
              (919, "pickup_datetime - to_seconds(600)"),
              (911, "pickup_datetime + to_seconds(trip_duration + 900)"))} AS TIMESTAMP)
    AS dropoff_datetime,
  CAST({first("l_linenumber", (887, "0"))} AS INTEGER) AS passenger_count,
  pickup_longitude, pickup_latitude,
  {first(point(-74049999, 23, 125000), (937, "pickup_longitude"), (857, "-190.0"))}
    AS dropoff_longitude,
  {first(point(40600001, 19, 150000), (937, "pickup_latitude"), (883, "42.0"))}
    AS dropoff_latitude,
  {first("CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END", (881, "NULL"), (947, "'y'"))}
    AS store_and_fwd_flag,
  trip_duration, source_hash || '.csv' AS source_file, source_hash
FROM starts"""

_TEXT = {c: f"coalesce(CAST({c} AS VARCHAR), '')" for c in SOURCE}
_TEXT["trip_duration"] = first(_TEXT["trip_duration"], (877, "'n/a'"))
_TEXT["dropoff_datetime"] = first(_TEXT["dropoff_datetime"], (863, "'not a time'"))
_TEXT["vendor_id"] = first(_TEXT["vendor_id"], (859, f"' ' || {_TEXT['vendor_id']} || ' '"))
STEPS["landed"] = ("SELECT " + ", ".join(f"{e} AS {c}" for c, e in _TEXT.items())
                   + ", source_file, source_hash FROM feed")

STEPS["occurring"] = """
SELECT id, count(*) AS n FROM feed WHERE id IS NOT NULL GROUP BY id"""

STEPS["trips"] = """
SELECT *,
  CAST(trip_duration AS DOUBLE) / 60 AS trip_duration_minutes,
  CAST(pickup_datetime AS DATE) AS pickup_date,
  CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
  CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
  CAST(weekofyear(pickup_datetime) AS INTEGER) AS pickup_week,
  CAST(day(pickup_datetime) AS INTEGER) AS pickup_day,
  dayname(pickup_datetime) AS day_of_week,
  CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
  coalesce(dayofweek(pickup_datetime) IN (0, 6), false) AS is_weekend,
  CASE hour(pickup_datetime) // 1
    WHEN 5 THEN 'Morning' WHEN 6 THEN 'Morning' WHEN 7 THEN 'Morning' WHEN 8 THEN 'Morning'
    WHEN 9 THEN 'Morning' WHEN 10 THEN 'Morning' WHEN 11 THEN 'Morning'
    WHEN 12 THEN 'Afternoon' WHEN 13 THEN 'Afternoon' WHEN 14 THEN 'Afternoon'
    WHEN 15 THEN 'Afternoon' WHEN 16 THEN 'Afternoon'
    WHEN 17 THEN 'Evening' WHEN 18 THEN 'Evening' WHEN 19 THEN 'Evening' WHEN 20 THEN 'Evening'
    ELSE 'Night' END AS time_of_day,
  date_diff('second', pickup_datetime, dropoff_datetime) AS observed_duration_seconds,
  date_diff('second', pickup_datetime, dropoff_datetime) - trip_duration
    AS duration_difference_seconds,
  CAST(km_u AS DOUBLE) / 1000000 AS estimated_distance_km,
  CASE WHEN trip_duration > 0
       THEN CAST((km_u * 7200 + trip_duration) // (2 * trip_duration) AS BIGINT) END AS kmh_u,
  CAST(kmh_u AS DOUBLE) / 1000000 AS estimated_speed_kmh
FROM (
  SELECT *, CASE WHEN pickup_latitude + pickup_longitude + dropoff_latitude + dropoff_longitude
                      IS NOT NULL THEN CAST(round(asin(least(1, sqrt(
      sin(radians(dropoff_latitude - pickup_latitude) / 2)
        * sin(radians(dropoff_latitude - pickup_latitude) / 2)
      + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
        * (sin(radians(dropoff_longitude - pickup_longitude) / 2)
           * sin(radians(dropoff_longitude - pickup_longitude) / 2))
    ))) * 12742 * 1000000) AS BIGINT) END AS km_u
  FROM feed)"""

_EARTH = ("coalesce({e}_latitude BETWEEN -90 AND 90 AND {e}_longitude BETWEEN -180 AND 180"
          " AND NOT ({e}_latitude = 0 AND {e}_longitude = 0){box}, false)")
_BOX = " AND {e}_latitude BETWEEN 40.4 AND 41.0 AND {e}_longitude BETWEEN -74.3 AND -73.7"


def judged(approved: bool) -> str:
    def plausible(end: str) -> str:
        return _EARTH.format(e=end, box=_BOX.format(e=end) if approved else "")

    vendor = "vendor_id IN (1, 2)" if approved else "vendor_id IS NOT NULL"
    seats = "passenger_count BETWEEN 1 AND 6" if approved else "passenger_count > 0"
    reasons = [("001", "MISSING_PRIMARY_KEY"), ("002", "DUPLICATE_PRIMARY_KEY"),
               ("003", "VENDOR_OUT_OF_DOMAIN"), ("004", "MISSING_PICKUP_TIMESTAMP"),
               ("005", "MISSING_DROPOFF_TIMESTAMP"), ("006", "NEGATIVE_TIME_INTERVAL"),
               ("007", "NON_POSITIVE_DURATION"), ("009", "PICKUP_COORDINATE_IMPLAUSIBLE"),
               ("010", "DROPOFF_COORDINATE_IMPLAUSIBLE"), ("012", "NEGATIVE_DERIVED_DISTANCE"),
               ("013", "NEGATIVE_DERIVED_SPEED")]
    ids = " ".join(f"WHEN NOT pass_dq_{n} THEN 'DQ-{n}'" for n, _ in reasons)
    texts = " ".join(f"WHEN NOT pass_dq_{n} THEN '{reason}'" for n, reason in reasons)
    return f"""
SELECT *, NOT pass_dq_008 AS is_passenger_count_anomaly,
  NOT pass_dq_011 AS is_store_fwd_flag_anomaly,
  CASE WHEN pickup_latitude + pickup_longitude + dropoff_latitude + dropoff_longitude IS NULL
         THEN 'GEO-001'
       WHEN greatest(abs(pickup_latitude), abs(dropoff_latitude)) > 90 THEN 'GEO-002'
       WHEN greatest(abs(pickup_longitude), abs(dropoff_longitude)) > 180 THEN 'GEO-003'
       WHEN NOT (pass_dq_009 AND pass_dq_010) THEN 'GEO-004'
       WHEN (pickup_latitude, pickup_longitude) = (dropoff_latitude, dropoff_longitude)
         THEN 'GEO-005' END AS coordinate_anomaly,
  CASE {ids} END AS rule_id, CASE {texts} END AS quarantine_reason,
  rule_id IS NULL AS is_valid_trip
FROM (
  SELECT t.*, o.n AS id_occurrences,
    t.id IS NOT NULL AS pass_dq_001,
    coalesce(o.n, 1) = 1 AS pass_dq_002,
    coalesce({vendor}, false) AS pass_dq_003,
    pickup_datetime IS NOT NULL AS pass_dq_004,
    dropoff_datetime IS NOT NULL AS pass_dq_005,
    coalesce(dropoff_datetime >= pickup_datetime, true) AS pass_dq_006,
    coalesce(trip_duration > 0, false) AS pass_dq_007,
    coalesce({seats}, false) AS pass_dq_008,
    {plausible("pickup")} AS pass_dq_009,
    {plausible("dropoff")} AS pass_dq_010,
    coalesce(store_and_fwd_flag IN ('Y', 'N'), false) AS pass_dq_011,
    coalesce(km_u >= 0, true) AS pass_dq_012,
    coalesce(kmh_u >= 0, true) AS pass_dq_013
  FROM trips t LEFT JOIN occurring o ON o.id = t.id)"""


STEPS["judged"] = judged(True)
STEPS["judged_unset"] = judged(False)


def valid(source: str, approved: bool) -> str:
    late = "trip_duration > 86400" if approved else "CAST(NULL AS BOOLEAN)"
    slow = "coalesce(estimated_speed_kmh < 5, false)" if approved else "CAST(NULL AS BOOLEAN)"
    return f"""
SELECT * REPLACE (upper(trim(store_and_fwd_flag)) AS store_and_fwd_flag),
  {cell("pickup")} AS pickup_area, {cell("dropoff")} AS dropoff_area,
  pickup_area || ' -> ' || dropoff_area AS route_key,
  {late} AS is_duration_outlier, {slow} AS is_speed_outlier
FROM {source} WHERE is_valid_trip"""


def cell(end: str) -> str:
    return (f"CAST(round({end}_latitude, 2) AS VARCHAR) || ',' ||"
            f" CAST(round({end}_longitude, 2) AS VARCHAR)")


STEPS["valid"] = valid("judged", True)
STEPS["valid_unset"] = valid("judged_unset", False)
STEPS["rejected"] = """
SELECT * REPLACE (trim(store_and_fwd_flag) AS store_and_fwd_flag)
FROM judged WHERE NOT is_valid_trip"""


def avg_seconds(places: int = 4, unit: int = 1) -> str:
    return ratio("sum(trip_duration)", f"count(trip_duration) * {unit}", places)


def avg_micro(column: str, places: int = 6) -> str:
    return ratio(f"sum({column})", f"count({column}) * 1000000", places)


def at(column: str, p: float, places: int = 4, divisor: str = "1") -> str:
    return f"round(quantile_cont({column}, {p}) / {divisor}, {places})"


_LONG = pct("count(*) FILTER (trip_duration > 3600)", "count(*)")
_SLOW = pct("count(*) FILTER (estimated_speed_kmh < 5)", "count(estimated_speed_kmh)")


def kpi_values(approved: bool = True) -> str:
    rates = (f"{_LONG} AS kpi_016_long_trip_rate_pct, {_SLOW} AS kpi_017_low_speed_rate_pct"
             if approved else
             "CAST(NULL AS DOUBLE) AS kpi_016_withheld_pending_long_trip_seconds,"
             " CAST(NULL AS DOUBLE) AS kpi_017_withheld_pending_low_speed_kmh")
    return f"""
  count(*) AS kpi_001_total_trips,
  {avg_seconds()} AS kpi_002_avg_duration_seconds,
  {avg_seconds(4, 60)} AS kpi_002_avg_duration_minutes,
  {at("trip_duration", 0.5)} AS kpi_003_median_duration_seconds,
  {at("trip_duration", 0.5, 4, "60")} AS kpi_003_median_duration_minutes,
  {at("trip_duration", 0.9)} AS kpi_004_p90_duration_seconds,
  {at("trip_duration", 0.9, 4, "60")} AS kpi_004_p90_duration_minutes,
  {avg_micro("km_u")} AS kpi_005_avg_estimated_distance_km,
  {avg_micro("kmh_u")} AS kpi_006_avg_estimated_speed_kmh,
  {rates},
  count(*) AS row_count"""


_PERFORMANCE_KEYS = "pickup_date, vendor_id, time_of_day, day_of_week, is_weekend"
STEPS["performance"] = f"""
SELECT {_PERFORMANCE_KEYS}, {kpi_values()} FROM valid GROUP BY ALL"""
STEPS["performance_unset"] = f"""
SELECT {_PERFORMANCE_KEYS}, {kpi_values(False)} FROM valid_unset GROUP BY ALL"""

STEPS["hours"] = """
SELECT pickup_date, pickup_hour, vendor_id, day_of_week, count(*) AS n
FROM valid GROUP BY ALL"""
STEPS["peaks"] = """
SELECT pickup_date, CAST(sum(n) AS BIGINT) AS day_trips,
  arg_min(pickup_hour, -n * 100 + pickup_hour) AS peak_hour, CAST(max(n) AS BIGINT) AS peak_trips
FROM (SELECT pickup_date, pickup_hour, sum(n) AS n FROM hours GROUP BY ALL)
GROUP BY pickup_date"""
STEPS["demand"] = """
SELECT pickup_date, pickup_hour, vendor_id, day_of_week, n AS kpi_008_trips_per_hour,
  day_trips AS kpi_007_trips_per_day, peak_hour AS kpi_009_peak_hour,
  peak_trips AS kpi_009_peak_hour_trip_count
FROM hours JOIN peaks USING (pickup_date)"""

_NO_VALUE = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in (
    "avg_duration_seconds", "median_duration_seconds", "p90_duration_seconds",
    "avg_estimated_distance_km", "avg_estimated_speed_kmh"))
STEPS["areas"] = f"""
SELECT 'pickup_area' AS dimension, pickup_area AS area_key, count(*) AS trip_count, {_NO_VALUE}
FROM valid GROUP BY pickup_area
UNION ALL BY NAME
SELECT 'dropoff_area' AS dimension, dropoff_area AS area_key, count(*) AS trip_count, {_NO_VALUE}
FROM valid GROUP BY dropoff_area
UNION ALL BY NAME
SELECT 'route' AS dimension, route_key AS area_key, count(*) AS trip_count,
  {avg_seconds()} AS avg_duration_seconds,
  {at("trip_duration", 0.5)} AS median_duration_seconds,
  {at("trip_duration", 0.9)} AS p90_duration_seconds,
  {avg_micro("km_u")} AS avg_estimated_distance_km,
  {avg_micro("kmh_u")} AS avg_estimated_speed_kmh
FROM valid GROUP BY route_key"""
STEPS["ranked"] = """
SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY trip_count DESC, area_key)
  AS rank_in_dimension
FROM areas"""

STEPS["vendors"] = f"""
SELECT vendor_id, count(*) AS vendor_trips,
  CAST(sum(count(*)) OVER () AS BIGINT) AS total_trips,
  {pct("count(*)", "sum(count(*)) OVER ()")} AS kpi_013_vendor_trip_share_pct,
  {avg_seconds()} AS kpi_014_avg_duration_seconds,
  {avg_seconds(4, 60)} AS kpi_014_avg_duration_minutes,
  {at("trip_duration", 0.9)} AS kpi_015_p90_duration_seconds,
  {at("trip_duration", 0.9, 4, "60")} AS kpi_015_p90_duration_minutes,
  {at("trip_duration", 0.5)} AS median_duration_seconds,
  {avg_micro("km_u")} AS avg_estimated_distance_km,
  {avg_micro("kmh_u")} AS avg_estimated_speed_kmh
FROM valid GROUP BY vendor_id"""


def score(rules: str) -> str:
    passed = " AND ".join(f"pass_dq_{n}" for n in rules.split())
    return pct(f"count(*) FILTER ({passed})", "count(*)")


def quality(source: str) -> str:
    return f"""
SELECT source_hash, min(source_file) AS source_file, count(*) AS total_records,
  count(*) FILTER (is_valid_trip) AS valid_records,
  count(*) FILTER (NOT is_valid_trip) AS quarantined_records,
  count(*) FILTER (id_occurrences > 1) AS duplicate_records,
  {pct("count(*) FILTER (is_valid_trip)", "count(*)")} AS kpi_018_data_quality_score_pct,
  {pct("count(*) FILTER (NOT is_valid_trip)", "count(*)")} AS kpi_019_invalid_record_rate_pct,
  {pct("count(*) FILTER (id_occurrences > 1)", "count(*)")} AS kpi_020_duplicate_rate_pct,
  {score("001 004 005")} AS completeness_score_pct,
  {score("002")} AS uniqueness_score_pct,
  {score("003 007")} AS validity_score_pct,
  {score("006")} AS consistency_score_pct,
  {score("009 010")} AS geographic_validity_score_pct,
  count(*) = count(*) FILTER (is_valid_trip) + count(*) FILTER (NOT is_valid_trip) AS reconciles
FROM {source} GROUP BY source_hash"""


STEPS["quality"] = quality("judged")
STEPS["quality_unset"] = quality("judged_unset")


def weighted(rate: str) -> str:
    units = f"sum(CAST(round({rate} * 10000) AS HUGEINT) * kpi_001_total_trips)"
    return f"{ratio(units, 'sum(kpi_001_total_trips) * 10000', 2)} AS {rate}"


STEPS["tiles"] = f"""
SELECT p.kpi_001_total_trips, o.* EXCLUDE (p50, p90),
  {shown("o.p50", 1, 4, 60)} AS kpi_003_median_duration_min,
  {shown("o.p90", 1, 4, 60)} AS kpi_004_p90_duration_min,
  b.kpi_009_peak_hour, p.kpi_016_long_trip_rate_pct, p.kpi_017_low_speed_rate_pct,
  s.kpi_018_data_quality_pct
FROM (SELECT CAST(sum(kpi_001_total_trips) AS BIGINT) AS kpi_001_total_trips,
        {weighted("kpi_016_long_trip_rate_pct")}, {weighted("kpi_017_low_speed_rate_pct")}
      FROM performance) p,
     (SELECT {avg_seconds(1, 60)} AS kpi_002_avg_duration_min,
        quantile_cont(trip_duration, 0.5) AS p50, quantile_cont(trip_duration, 0.9) AS p90,
        {avg_micro("km_u", 2)} AS kpi_005_avg_estimated_distance_km,
        {avg_micro("kmh_u", 1)} AS kpi_006_avg_estimated_speed_kmh FROM valid) o,
     (SELECT kpi_009_peak_hour FROM demand
      ORDER BY kpi_009_peak_hour_trip_count DESC, pickup_date LIMIT 1) b,
     (SELECT {pct("sum(valid_records)", "sum(total_records)", 2)} AS kpi_018_data_quality_pct
      FROM quality) s"""

STEPS["trend"] = """
SELECT pickup_date, pickup_hour, CAST(sum(n) AS BIGINT) AS trips_per_hour,
  day_trips AS trips_per_day
FROM hours JOIN peaks USING (pickup_date) GROUP BY pickup_date, pickup_hour, day_trips"""


def blank(column: str) -> str:
    return f"nullif(trim({column}), '') IS NULL"


def unpivot(rows: list[str], source: str) -> str:
    """One SELECT per output row over a one-row step."""
    return " UNION ALL ".join(f"SELECT {r} FROM {source}" for r in rows)


STEPS["blanks"] = ("SELECT count(*) AS total, " + ", ".join(
    f"count(*) FILTER ({blank(c)}) AS {c}" for c in SOURCE) + " FROM landed")
STEPS["id_copies"] = f"""
SELECT count(*) AS distinct_ids, count(*) FILTER (n > 1) AS duplicated_ids,
  CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT id, count(*) AS n FROM landed WHERE NOT {blank("id")} GROUP BY id)"""
STEPS["row_copies"] = f"""
SELECT count(*) AS duplicated_payloads, CAST(coalesce(sum(n), 0) AS BIGINT) AS exact_duplicate_rows
FROM (SELECT count(*) AS n FROM landed GROUP BY {", ".join(SOURCE)} HAVING count(*) > 1)"""
STEPS["domains"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS count FROM landed GROUP BY {c}"
    for c in ("vendor_id", "store_and_fwd_flag", "passenger_count"))
STEPS["geo_counts"] = """
SELECT count(*) AS total,
  count(*) FILTER (pickup_latitude + pickup_longitude + dropoff_latitude + dropoff_longitude
                   IS NULL) AS geo_001,
  count(*) FILTER (abs(pickup_latitude) > 90 OR abs(dropoff_latitude) > 90) AS geo_002,
  count(*) FILTER (abs(pickup_longitude) > 180 OR abs(dropoff_longitude) > 180) AS geo_003,
  count(*) FILTER (pickup_latitude = 0 AND pickup_longitude = 0) AS geo_at_origin,
  count(*) FILTER (pickup_latitude = dropoff_latitude AND pickup_longitude = dropoff_longitude)
    AS geo_005,
  count(*) FILTER (trip_duration = 0) AS zero_duration,
  count(*) FILTER (trip_duration < 0) AS negative_duration,
  count(*) FILTER (trip_duration IS NULL) AS null_duration,
  count(*) FILTER (km_u = 0) AS zero_distance,
  count(*) FILTER (duration_difference_seconds <> 0) AS mismatch
FROM trips"""

_POINTS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99,
           "p995": 0.995, "p999": 0.999}
_MEASURES = (("duration", "trip_duration", "trip_duration", 1),
             ("distance", "estimated_distance_km", "km_u", 1000000),
             ("speed", "estimated_speed_kmh", "kmh_u", 1000000))


def _numeric(name: str, column: str, units: str, scale: int) -> str:
    points = ", ".join(f"{at(units, p, 9, str(scale))} AS {label}" for label, p in _POINTS.items())
    mean = ratio(f"sum({units})", f"count({units}) * {scale}", 6)
    return (f"SELECT '{name}' AS column_name, count({column}) AS n,"
            f" CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max,"
            f" {mean} AS mean, round(stddev_samp({column}), 6) AS stddev, {points} FROM trips")


STEPS["numeric"] = " UNION ALL ".join(_numeric(*m) for m in _MEASURES)

_RULE_NAMES = {
    "001": ("id_not_null", "reject"), "002": ("id_unique", "reject"),
    "003": ("vendor_id_in_domain", "reject"), "004": ("pickup_datetime_not_null", "reject"),
    "005": ("dropoff_datetime_not_null", "reject"), "006": ("dropoff_not_before_pickup", "reject"),
    "007": ("trip_duration_positive", "reject"), "008": ("passenger_count_in_domain", "flag"),
    "009": ("pickup_coordinates_plausible", "reject"),
    "010": ("dropoff_coordinates_plausible", "reject"),
    "011": ("store_and_fwd_flag_in_domain", "flag"),
    "012": ("estimated_distance_non_negative", "reject"),
    "013": ("estimated_speed_non_negative", "reject"),
}


def rule_counts(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT 'DQ-{n}' AS rule_id, '{action}' AS action,"
        f" count(*) FILTER (pass_dq_{n}) AS passed, count(*) FILTER (NOT pass_dq_{n}) AS failed"
        f" FROM {source}" for n, (_, action) in _RULE_NAMES.items())


STEPS["positive"] = "SELECT trip_duration, ln(1 + trip_duration) AS x FROM trips WHERE trip_duration > 0"


def statement(final: str) -> str:
    """The final SELECT with the steps it needs, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                visit(STEPS[name])
                needed.append(name)

    visit(final)
    order = [n for n in STEPS if n in needed]
    if not order:
        return final.strip()
    steps = ",\n".join(f"{name} AS ({STEPS[name].strip()})" for name in order)
    return f"WITH {steps}\n{final.strip()}"


_READ = {"vendor_id": "INTEGER", "pickup_datetime": "TIMESTAMP", "dropoff_datetime": "TIMESTAMP",
         "passenger_count": "INTEGER", "trip_duration": "BIGINT",
         **{f"{end}_{axis}": "DOUBLE" for end in ("pickup", "dropoff")
            for axis in ("latitude", "longitude")}}


def built(final: str) -> str:
    """The statement with its trips read back from landing text, as the build gets them."""
    whole = statement(final)
    cells = ", ".join(f"TRY_CAST({v} AS {_READ[c]}) AS {c}" if c in _READ else f"{v} AS {c}"
                      for c in SOURCE for v in [
                          # The flag keeps its text, a blank one too, as silver_typed has it.
                          c if c == "store_and_fwd_flag" else f"nullif(trim({c}), '')"])
    landed = STEPS["landed"].replace("FROM feed", "FROM given")
    assert "\nfeed AS (" in whole and "landed AS (" not in whole
    head, tail = whole.split("\nfeed AS (", 1)
    feed, rest = tail[:len(STEPS["feed"].strip())], tail[len(STEPS["feed"].strip()):]
    return (f"{head}\ngiven AS ({feed}),\nlanded AS ({landed}),\nfeed AS ("
            f"SELECT {cells}, source_file, source_hash FROM landed{rest}")
