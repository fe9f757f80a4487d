"""Approved cutoffs, the KPI contract, and the gate that stops a build when a cutoff is missing."""

from __future__ import annotations

from dataclasses import dataclass, fields

# Fixed value: a cutoff that carries this text (or None) has not been approved.
PENDING = "TBD_PENDING_PROFILING"


class UnapprovedThreshold(ValueError):
    """A KPI or flag needs a cutoff nobody has approved."""


@dataclass(frozen=True)
class Box:
    """Rectangle of plausible coordinates, bounds included."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


@dataclass(frozen=True)
class Settings:
    """The one place a numeric cutoff is written down. Fixed values, approved by the data owner."""

    vendor_domain: tuple[int, ...] | str | None = (1, 2)
    passenger_count_domain: tuple[int, int] | str | None = (1, 6)
    nyc_bounds: Box | str | None = Box(40.4, 41.0, -74.3, -73.7)
    long_trip_seconds: int | str | None = 3600
    low_speed_kmh: float | str | None = 5
    extreme_duration_seconds: int | str | None = 86400
    extreme_distance_km: float | str | None = 100

    def approved(self, name: str) -> bool:
        return getattr(self, name) not in (None, PENDING)

    def get(self, name: str):
        """The approved value, or None while it is pending."""
        return getattr(self, name) if self.approved(name) else None

    def require(self, name: str):
        """The approved value, or an error that names what is missing. Never a default."""
        if not self.approved(name):
            raise UnapprovedThreshold(f"threshold '{name}' is not approved; no default is used")
        return getattr(self, name)

    def pending(self) -> list[str]:
        return [f.name for f in fields(self) if not self.approved(f.name)]


@dataclass(frozen=True)
class Kpi:
    kpi_id: str
    name: str
    mart: str
    columns: tuple[str, ...]
    dimensions: tuple[str, ...] = ()
    threshold: str | None = None


_ALL_DIMS = ("date", "day_of_week", "hour", "time_of_day", "vendor",
             "pickup_area", "dropoff_area", "route")
_TIME_DIMS = ("date", "day_of_week", "hour", "time_of_day", "vendor")

# The KPI contract (ids, names, marts, output columns, drill-down dimensions).
KPIS = (
    Kpi("KPI-001", "Total Trips", "trip_performance", ("kpi_001_total_trips",), _ALL_DIMS),
    Kpi("KPI-002", "Average Trip Duration", "trip_performance",
        ("kpi_002_avg_duration_seconds", "kpi_002_avg_duration_minutes"), _ALL_DIMS),
    Kpi("KPI-003", "Median Trip Duration", "trip_performance",
        ("kpi_003_median_duration_seconds", "kpi_003_median_duration_minutes"), _TIME_DIMS),
    Kpi("KPI-004", "P90 Trip Duration", "trip_performance",
        ("kpi_004_p90_duration_seconds", "kpi_004_p90_duration_minutes"), _TIME_DIMS),
    Kpi("KPI-005", "Average Estimated Distance", "trip_performance",
        ("kpi_005_avg_estimated_distance_km",),
        ("date", "vendor", "pickup_area", "dropoff_area", "route")),
    Kpi("KPI-006", "Average Estimated Speed", "trip_performance",
        ("kpi_006_avg_estimated_speed_kmh",), ("date", "hour", "vendor", "route")),
    Kpi("KPI-007", "Trips Per Day", "demand_metrics", ("kpi_007_trips_per_day",),
        ("vendor", "time_of_day", "pickup_area")),
    Kpi("KPI-008", "Trips Per Hour", "demand_metrics", ("kpi_008_trips_per_hour",),
        ("vendor", "day_of_week")),
    Kpi("KPI-009", "Peak Demand Hour", "demand_metrics",
        ("kpi_009_peak_hour", "kpi_009_peak_hour_trip_count")),
    Kpi("KPI-010", "Top Pickup Area", "geographic_metrics", ("area_key", "trip_count")),
    Kpi("KPI-011", "Top Drop-off Area", "geographic_metrics", ("area_key", "trip_count")),
    Kpi("KPI-012", "Top Route", "geographic_metrics",
        ("area_key", "trip_count", "avg_duration_seconds", "median_duration_seconds",
         "p90_duration_seconds", "avg_estimated_distance_km", "avg_estimated_speed_kmh")),
    Kpi("KPI-013", "Vendor Trip Share", "vendor_performance", ("kpi_013_vendor_trip_share_pct",)),
    Kpi("KPI-014", "Vendor Average Duration", "vendor_performance",
        ("kpi_014_avg_duration_seconds", "kpi_014_avg_duration_minutes")),
    Kpi("KPI-015", "Vendor P90 Duration", "vendor_performance",
        ("kpi_015_p90_duration_seconds", "kpi_015_p90_duration_minutes",
         "median_duration_seconds", "avg_estimated_distance_km", "avg_estimated_speed_kmh")),
    Kpi("KPI-016", "Long Trip Rate", "trip_performance", ("kpi_016_long_trip_rate_pct",),
        ("date", "day_of_week", "time_of_day", "vendor"), threshold="long_trip_seconds"),
    Kpi("KPI-017", "Low-Speed Trip Rate", "trip_performance", ("kpi_017_low_speed_rate_pct",),
        ("date", "day_of_week", "time_of_day", "vendor"), threshold="low_speed_kmh"),
    Kpi("KPI-018", "Data Quality Score", "data_quality", ("kpi_018_data_quality_score_pct",)),
    Kpi("KPI-019", "Invalid Record Rate", "data_quality", ("kpi_019_invalid_record_rate_pct",)),
    Kpi("KPI-020", "Duplicate Rate", "data_quality", ("kpi_020_duplicate_rate_pct",)),
)
KPI_BY_ID = {k.kpi_id: k for k in KPIS}


def gate(settings: Settings, allow_withheld: bool = False) -> list[str]:
    """Stop before anything is planned when a KPI lacks its cutoff.

    Returns the ids of withheld KPIs when ``allow_withheld`` is set.
    """
    blocked = [k for k in KPIS if k.threshold and not settings.approved(k.threshold)]
    if blocked and not allow_withheld:
        wanted = ", ".join(f"{k.kpi_id} ({k.threshold})" for k in blocked)
        raise UnapprovedThreshold(f"build stopped, unapproved thresholds: {wanted}")
    return [k.kpi_id for k in blocked]


def withheld_column(kpi_id: str, threshold: str) -> str:
    return f"{kpi_id.lower().replace('-', '_')}_withheld_pending_{threshold}"
