"""Row-level quality rules as data, and the split into valid and quarantined rows.

One ordered list drives the pass columns, the rejection reason, the profiling counts and the
tests, so these cannot disagree. A rule that cannot decide (NULL) fails: every row ends up in
exactly one of the two tables.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.config import Settings
from tripledger.functions.geo import cell, route
from tripledger.operators.occurrences import only_once, with_id_occurrences
from tripledger.operators.once import computed_once, settled
from tripledger.operators.typing import derived

Predicate = Callable[[Settings], Column]


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    action: str  # reject, flag or policy
    outcome: str | None = None  # rejection reason, or name of the flag column
    predicate: Predicate | None = None
    parameter: str | None = None
    component: str | None = None

    @property
    def column(self) -> str:
        return f"pass_{self.rule_id.lower().replace('-', '_')}"


def _plausible_point(end: str) -> Predicate:
    def predicate(settings: Settings) -> Column:
        lat, lon = F.col(f"{end}_latitude"), F.col(f"{end}_longitude")
        box = settings.get("nyc_bounds")
        on_earth = (lat.between(-90, 90) & lon.between(-180, 180)
                    & ~((lat == 0) & (lon == 0)))
        if box is None:
            return on_earth
        return (on_earth & lat.between(box.lat_min, box.lat_max)
                & lon.between(box.lon_min, box.lon_max))
    return predicate


def _known_vendor(settings: Settings) -> Column:
    domain = settings.get("vendor_domain")
    vendor = F.col("vendor_id")
    return vendor.isNotNull() if domain is None else vendor.isin(*domain)


def _plausible_passengers(settings: Settings) -> Column:
    domain = settings.get("passenger_count_domain")
    passengers = F.col("passenger_count")
    return passengers > 0 if domain is None else passengers.between(*domain)


def _not_negative(name: str) -> Predicate:
    return lambda settings: F.coalesce(F.col(name) >= 0, F.lit(True))


def _present(name: str) -> Predicate:
    return lambda settings: F.col(name).isNotNull()


def _ordered_times(settings: Settings) -> Column:
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return pickup.isNull() | dropoff.isNull() | (dropoff >= pickup)


# Rule ids, names, actions, reasons and flag columns, in order of precedence.
RULES = (
    Rule("DQ-001", "id_not_null", "reject", "MISSING_PRIMARY_KEY",
         _present("id"), component="completeness"),
    Rule("DQ-002", "id_unique", "reject", "DUPLICATE_PRIMARY_KEY",
         lambda s: F.coalesce("id_occurrences", F.lit(1)) == 1, component="uniqueness"),
    Rule("DQ-003", "vendor_id_in_domain", "reject", "VENDOR_OUT_OF_DOMAIN",
         _known_vendor, "vendor_domain", "validity"),
    Rule("DQ-004", "pickup_datetime_not_null", "reject", "MISSING_PICKUP_TIMESTAMP",
         _present("pickup_datetime"), component="completeness"),
    Rule("DQ-005", "dropoff_datetime_not_null", "reject", "MISSING_DROPOFF_TIMESTAMP",
         _present("dropoff_datetime"), component="completeness"),
    Rule("DQ-006", "dropoff_not_before_pickup", "reject", "NEGATIVE_TIME_INTERVAL",
         _ordered_times, component="consistency"),
    Rule("DQ-007", "trip_duration_positive", "reject", "NON_POSITIVE_DURATION",
         lambda s: F.col("trip_duration") > 0, component="validity"),
    Rule("DQ-008", "passenger_count_in_domain", "flag", "is_passenger_count_anomaly",
         _plausible_passengers, "passenger_count_domain"),
    Rule("DQ-009", "pickup_coordinates_plausible", "reject", "PICKUP_COORDINATE_IMPLAUSIBLE",
         _plausible_point("pickup"), "nyc_bounds", "geographic_validity"),
    Rule("DQ-010", "dropoff_coordinates_plausible", "reject", "DROPOFF_COORDINATE_IMPLAUSIBLE",
         _plausible_point("dropoff"), "nyc_bounds", "geographic_validity"),
    Rule("DQ-011", "store_and_fwd_flag_in_domain", "flag", "is_store_fwd_flag_anomaly",
         lambda s: F.col("store_and_fwd_flag_original").isin("Y", "N")),
    Rule("DQ-012", "estimated_distance_non_negative", "reject", "NEGATIVE_DERIVED_DISTANCE",
         _not_negative("estimated_distance_km")),
    Rule("DQ-013", "estimated_speed_non_negative", "reject", "NEGATIVE_DERIVED_SPEED",
         _not_negative("estimated_speed_kmh")),
    Rule("DQ-014", "outliers_flagged_never_deleted", "policy"),
    Rule("DQ-015", "rejections_are_auditable", "policy"),
)
CHECKED = tuple(r for r in RULES if r.predicate)
UNIQUE = next(r for r in CHECKED if r.name == "id_unique")
REJECTING = tuple(r for r in CHECKED if r.action == "reject")
FLAGGING = tuple(r for r in CHECKED if r.action == "flag")
COMPONENTS = ("completeness", "uniqueness", "validity", "consistency", "geographic_validity")


def all_of(conditions) -> Column:
    return reduce(operator.and_, conditions)


def any_of(conditions) -> Column:
    return reduce(operator.or_, conditions)


# Column with a row's failed rules: a bit for each checked rule, in order of precedence.
FAILED = "failed_rules"
_BIT = {r.rule_id: 1 << i for i, r in enumerate(CHECKED)}


def bits(found) -> int:
    return sum(_BIT[r.rule_id] for r in found)


_REJECTING_BITS = bits(REJECTING)


def failed_rules(settings: Settings) -> Column:
    """The bits of the rules a row fails; a rule that cannot decide fails."""
    return reduce(lambda a, b: a.bitwiseOR(b), [
        F.when(r.predicate(settings), 0).otherwise(_BIT[r.rule_id]) for r in CHECKED])


def passes(*found: Rule) -> Column:
    """Whether a row passes all of these rules."""
    return F.col(FAILED).bitwiseAND(bits(found)) == 0


def failures_of(rule: Rule) -> Column:
    """1 where a row fails the rule, else 0."""
    return F.shiftright(F.col(FAILED), CHECKED.index(rule)).bitwiseAND(F.lit(1))


def _first_failure(values: list[str | None]) -> Column:
    """The value, one for each checked rule, of the first rejecting rule a row fails, else NULL: the
    place of the lowest bit is the number of bits below it."""
    failed = F.col(FAILED).bitwiseAND(_REJECTING_BITS)
    below = F.bit_count(failed.bitwiseAND(-failed) - 1)
    listed = F.array(*[F.lit(v).cast("string") for v in values])
    return F.when(failed != 0, F.get(listed, below))


def coordinate_class() -> Column:
    """Class of a coordinate problem, the first that applies; GEO-005 is not a rejection."""
    lats = [F.col("pickup_latitude"), F.col("dropoff_latitude")]
    lons = [F.col("pickup_longitude"), F.col("dropoff_longitude")]
    return (
        F.when(any_of(c.isNull() for c in lats + lons), "GEO-001")
        .when(any_of(F.abs(c) > 90 for c in lats), "GEO-002")
        .when(any_of(F.abs(c) > 180 for c in lons), "GEO-003")
        .when(~passes(*[r for r in CHECKED if r.component == "geographic_validity"]), "GEO-004")
        .when((lats[0] == lats[1]) & (lons[0] == lons[1]), "GEO-005")
    )


def judge(rows: DataFrame, settings: Settings) -> DataFrame:
    """Add the failed rules as a bitmask, and what follows from its bits: one pass column per rule, the
    flags, the coordinate class and the verdict.

    Needs the derived columns and ``id_occurrences``. Predicates are evaluated once per row.
    """
    masked = computed_once(rows, {FAILED: failed_rules(settings)})
    return masked.withColumns({
        **{r.column: passes(r) for r in CHECKED},
        **{r.outcome: ~passes(r) for r in FLAGGING},
        "coordinate_anomaly": coordinate_class(),
        "rule_id": _first_failure([r.rule_id for r in CHECKED]),
        "quarantine_reason": _first_failure([r.outcome for r in CHECKED]),
        "is_valid_trip": passes(*REJECTING),
    })


def evaluate(trips: DataFrame, settings: Settings, repeated: DataFrame | None = None) -> DataFrame:
    """Every typed row with its derived values and rule outcomes."""
    return judge(derived(settled(with_id_occurrences(trips, repeated=repeated)), once=True), settings)


def _trusted(judged: DataFrame, settings: Settings) -> DataFrame:
    """Columns of the valid table; statistical extremes are marked and kept."""
    long_limit, slow_limit = settings.get("extreme_duration_seconds"), settings.get("low_speed_kmh")
    undecided = F.lit(None).cast("boolean")
    pickup_area = cell(F.col("pickup_latitude"), F.col("pickup_longitude"))
    dropoff_area = cell(F.col("dropoff_latitude"), F.col("dropoff_longitude"))
    return judged.where("is_valid_trip").select(
        "id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
        "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
        F.col("store_and_fwd_flag_raw").alias("store_and_fwd_flag"),
        "trip_duration", "trip_duration_minutes",
        "pickup_date", "pickup_year", "pickup_month", "pickup_week", "pickup_day",
        "day_of_week", "pickup_hour", "is_weekend", "time_of_day",
        "estimated_distance_km", "estimated_speed_kmh",
        "observed_duration_seconds", "duration_difference_seconds",
        pickup_area.alias("pickup_area"),
        dropoff_area.alias("dropoff_area"),
        route(pickup_area, dropoff_area).alias("route_key"),
        *[r.outcome for r in FLAGGING],
        "coordinate_anomaly",
        (undecided if long_limit is None else F.col("trip_duration") > long_limit)
        .alias("is_duration_outlier"),
        (undecided if slow_limit is None
         else F.coalesce(F.col("estimated_speed_kmh") < slow_limit, F.lit(False)))
        .alias("is_speed_outlier"),
        F.lit(True).alias("is_valid_trip"),
        "source_file", "source_hash",
        *[c for c in ("ingested_at",) if c in judged.columns],
    )


def quarantined(judged: DataFrame) -> DataFrame:
    """Rejected rows with the first rule they fail; source values kept for a replay."""
    return judged.where(~F.col("is_valid_trip")).select(
        "id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
        "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
        F.col("store_and_fwd_flag_original").alias("store_and_fwd_flag"),
        "trip_duration", "estimated_distance_km", "estimated_speed_kmh",
        "rule_id", "quarantine_reason", "coordinate_anomaly", "source_file", "source_hash",
        *[c for c in ("ingested_at",) if c in judged.columns],
    )


def split(judged: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The valid and the quarantined part of an evaluated (stored) table."""
    return _trusted(judged, settings), quarantined(judged)


def valid_trips(trips: DataFrame, settings: Settings, repeated: DataFrame | None = None) -> DataFrame:
    """The valid table straight from typed rows.

    Same rows as ``split(evaluate(trips))[0]``, for callers who do not need the rejected rows: rows of
    repeated ids go first, and derivations are only for rows that stay.
    """
    return _trusted(judge(derived(settled(only_once(trips, repeated=repeated)), once=True), settings),
                    settings)
