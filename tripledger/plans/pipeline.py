"""The whole build: landed text to silver tables to KPI tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.config import Settings, gate
from tripledger.operators.rules import evaluate, split
from tripledger.operators.typing import typed
from tripledger.plans import expectations as ex
from tripledger.plans import marts, profile
from tripledger.sources.tables import Store

@dataclass(frozen=True)
class Model:
    """A table of the build: what it is made of, and how. ``landed`` is the text of the files."""

    layer: str
    parents: tuple[str, ...]
    make: Callable[..., DataFrame]  # of the settings and the parents


MODELS = {
    "silver_dq_evaluated": Model("silver", ("landed",), lambda s, landed: evaluate(typed(landed), s)),
    "silver_trips": Model("silver", ("silver_dq_evaluated",), lambda s, judged: split(judged, s)[0]),
    "silver_trips_quarantine": Model("silver", ("silver_dq_evaluated",),
                                     lambda s, judged: split(judged, s)[1]),
    # First of the marts: what it alone is made of can go before the others are made.
    "data_quality": Model("gold", ("silver_dq_evaluated", "silver_trips", "silver_trips_quarantine"),
                          lambda s, judged, valid, rejected: marts.data_quality(judged, valid, rejected)),
    "trip_performance": Model("gold", ("silver_trips",), lambda s, valid: marts.trip_performance(
        valid, s, allow_withheld=True)),  # the gate of the build has decided
    "demand_metrics": Model("gold", ("silver_trips",), lambda s, valid: marts.demand_metrics(valid)),
    "geographic_metrics": Model("gold", ("silver_trips",),
                                lambda s, valid: marts.geographic_metrics(valid)),
    "vendor_performance": Model("gold", ("silver_trips",),
                                lambda s, valid: marts.vendor_performance(valid)),
}
GOLD = tuple(name for name, model in MODELS.items() if model.layer == "gold")

# Checks by name: the tables they read, and the rows they object to.
TESTS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "silver_trips_id_not_null": (("silver_trips",), lambda s, t: ex.expect_not_null(t, "id")),
    "silver_trips_id_unique": (("silver_trips",), lambda s, t: ex.expect_unique(t, "id")),
    "quarantine_rule_accepted": (("silver_trips_quarantine",), lambda s, t: ex.expect_accepted(
        t, "rule_id", ex.REJECTING_RULE_IDS)),
    "vendor_unique": (("vendor_performance",), lambda s, t: ex.expect_unique(t, "vendor_id")),
    "peak_hour_accepted": (("demand_metrics",), lambda s, t: ex.expect_accepted(
        t, "kpi_009_peak_hour", range(24))),
    "dimension_accepted": (("geographic_metrics",), lambda s, t: ex.expect_accepted(
        t, "dimension", ex.DIMENSIONS)),
    "duration_positive": (("silver_trips",), lambda s, t: ex.assert_duration_positive(t)),
    "measures_non_negative": (("silver_trips",), lambda s, t: ex.assert_non_negative(t)),
    "quarantine_has_reason": (("silver_trips_quarantine",), lambda s, t: ex.assert_has_reason(t)),
    "reconciliation": (("data_quality",), lambda s, t: ex.assert_reconciliation(t)),
    "vendor_share_100": (("vendor_performance",), lambda s, t: ex.assert_share_100(t)),
    "no_overlap": (("silver_trips", "silver_trips_quarantine"), lambda s, a, b: ex.audit_overlap(a, b)),
}


def with_parents(names: Iterable[str]) -> list[str]:
    """The models and all they are made of, in an order in which they can be built."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in MODELS:
            raise KeyError(f"no model {name}; there are {', '.join(MODELS)}")
        wanted.add(name)
        for parent in MODELS[name].parents:
            if parent != "landed" and parent not in wanted:
                add(parent)
    for name in names:
        add(name)
    return [name for name in MODELS if name in wanted]


def build(landed: DataFrame, store: Store, settings: Settings, allow_withheld: bool = False,
          select: Iterable[str] | None = None, parents: bool = True,
          keep: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Build all models, or those selected, and return the tables as stored.

    Selected models are built with all they are made of; without ``parents`` these are taken as the
    store has them. The gate runs before anything is read. Tables are written, not cached: losing an
    executor afterwards costs nothing, and each model starts from a short lineage.

    With ``keep``, only these tables are wanted in the end: of the others, each leaves the store as soon
    as nothing is left to be made of it.
    """
    gate(settings, allow_withheld)
    chosen = list(MODELS) if select is None else list(select)
    order = with_parents(chosen) if parents else [m for m in with_parents(chosen) if m in chosen]
    kept = set(MODELS) if keep is None else set(keep)
    tables: dict[str, DataFrame] = {}

    def parent(name: str) -> DataFrame:
        if name == "landed":
            return landed
        return tables[name] if name in tables else store.read(MODELS[name].layer, name)
    for done, name in enumerate(order, 1):
        model = MODELS[name]
        rows = model.make(settings, *[parent(p) for p in model.parents])
        tables[name] = store.replace(model.layer, name, rows)
        needed = {p for later in order[done:] for p in MODELS[later].parents}
        for spent in {name, *model.parents} - {"landed"} - kept - needed:
            store.drop(MODELS[spent].layer, spent)
            tables.pop(spent, None)
    return tables


def check(store: Store, settings: Settings, select: Iterable[str] | None = None) -> DataFrame:
    """(check, offending_rows) of all tests, or of those selected, over the tables as stored."""
    names = list(TESTS) if select is None else list(select)
    if unknown := [n for n in names if n not in TESTS]:
        raise KeyError(f"no test {', '.join(unknown)}; there are {', '.join(TESTS)}")
    read: dict[str, DataFrame] = {}
    found = {}
    for name in names:
        tables, offending = TESTS[name]
        for table in tables:
            read[table] = read.get(table) or store.read(MODELS[table].layer, table)
        found[name] = offending(settings, *[read[t] for t in tables])
    return ex.offences(found)


def write_profile(landed: DataFrame, judged: DataFrame, store: Store, settings: Settings,
                  run_id: str, at: datetime) -> dict[str, DataFrame]:
    """The six profile tables, written from the frames that compute them, each row with its run.

    ``judged`` is read several times: pass the stored table of a build.
    """
    tables = {
        "profile_run": profile.profile_run(landed, run_id, at),
        "profile_schema": profile.profile_schema(landed),
        "profile_numeric_stats": profile.profile_numeric_stats(judged),
        "profile_domain_stats": profile.profile_domain_stats(landed),
        "profile_quality": profile.profile_quality(judged, settings),
        "profile_anomalies": profile.profile_anomalies(judged),
    }
    return {name: store.replace("profile", name, rows.withColumn("profiling_run_id", F.lit(run_id)))
            for name, rows in tables.items()}


def valid_rates(quality: DataFrame, run_number: int) -> DataFrame:
    """What `distributions.valid_rate_drift` compares between runs."""
    return quality.select(F.lit(run_number).alias("run_number"), "source_hash", "total_records",
                          "valid_records")

