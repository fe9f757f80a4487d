"""KPI tables kept up to date batch by batch, without reading old batches again.

What a batch adds is stored as partial aggregates that are merged by addition: trips counted by the keys
of the KPI tables and by duration, and rows counted by the rules they fail. All have the batch's
``source_hash``. An index of ids tells what a new batch changes in old ones: an id that a new batch
repeats was valid in an old one, so the old trip is added with a count of minus one, and its row moves
from its failed rules to the same with DQ-002. Every update only appends; the KPI tables are sums over
the parts, and equal those of a whole build over all batches.

An update writes its parts under a folder of its own and then takes the next number of the state's log.
Of two updates at once the second one gets `Conflict` and is run again on the new state; parts that no
entry names are never read. The index is narrow, and a batch meets it by a join on its ids alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.config import Settings, gate
from tripledger.operators import rules
from tripledger.operators.histogram import CELL_SUMS, duration_cells
from tripledger.operators.occurrences import id_counts
from tripledger.plans import marts
from tripledger.sources.stages import stored
from tripledger.sources.tables import Store

LAYER, NAME = "state", "marts"
KEYS = ("source_hash", "pickup_date", "pickup_hour", "time_of_day", "vendor_id")
PARTS = ("trip_cells", "route_cells", "rule_counts", "ids")


class Incremental:
    def __init__(self, spark: SparkSession, root: str, settings: Settings):
        self.spark, self.settings = spark, settings
        self.store = Store(spark, root)

    def _state(self) -> tuple[int, dict]:
        number, entry = self.store.current(LAYER, NAME)
        return number, entry or {"loads": [], "batches": {}}

    def _part(self, load: str, part: str) -> str:
        return f"{self.store.path(LAYER, NAME, load)}/{part}"

    def _read(self, entry: dict, part: str, loads: list[str] | None = None) -> DataFrame | None:
        found = entry["loads"] if loads is None else loads
        return self.spark.read.parquet(*[self._part(x, part) for x in found]) if found else None

    def update(self, typed: DataFrame, name: str | None = None) -> str | None:
        """Add the batches of typed rows, and return the load's name, or None if all are known.

        Rows of batches that the state has already are left out, so a repeated update changes nothing.
        """
        number, entry = self._state()
        batches = [r.source_hash for r in typed.select("source_hash").distinct().collect()]
        new = [b for b in batches if b not in entry["batches"]]
        if not new:
            return None
        rows = typed.where(F.col("source_hash").isin(new))
        load = name or uuid.uuid4().hex
        counts = stored(id_counts(rows), "batch-ids")
        index = self._read(entry, "ids")
        if index is None:
            met, repeated = None, counts.where("n > 1")
        else:
            # The index rows of ids this batch has: the trip itself, or a mark that the id is repeated.
            met = stored(index.join(counts.select("id"), "id", "left_semi"), "met-ids")
            known = met.groupBy("id").agg(F.max("repeated").alias("repeated"))
            repeated = (counts.join(known, "id", "left")
                        .where("n > 1 OR repeated IS NOT NULL")
                        .select("id", (F.col("n") + 1).alias("n")))
        repeated = stored(repeated, "repeated-ids")
        judged = stored(rules.evaluate(rows, self.settings, repeated), "batch-judged")
        valid = rules.split(judged, self.settings)[0]
        single = judged.where("id IS NOT NULL").where(rules.passes(rules.UNIQUE))
        indexed = single.select(*_index_columns(), F.lit(False).alias("repeated"))
        marks = repeated.select("id", F.lit(True).alias("repeated"))
        ids = indexed.unionByName(marks, allowMissingColumns=True)
        trip_cells, route_cells = self._cells(valid), self._routes(valid)
        by_rule = judged.groupBy("source_hash", "source_file", rules.FAILED).agg(F.count("*").alias("n"))
        if met is not None:
            # Trips of old batches whose id is repeated now, for the first time.
            again = met.groupBy("id").agg(F.max("repeated").alias("known")).where("NOT known")
            moved = stored(met.join(again.select("id"), "id", "left_semi"), "moved-trips")
            gone = moved.where(rules.passes(*rules.REJECTING))
            trip_cells = trip_cells.unionByName(_negative(self._cells(gone)))
            route_cells = route_cells.unionByName(_negative(self._routes(gone)))
            one = F.lit(1).cast("bigint")
            away = moved.select("source_hash", "source_file", rules.FAILED, (-one).alias("n"))
            back = moved.select("source_hash", "source_file", F.col(rules.FAILED).bitwiseOR(
                rules.bits([rules.UNIQUE])).alias(rules.FAILED), one.alias("n"))
            by_rule = by_rule.unionByName(away).unionByName(back)
        for part, frame in zip(PARTS, (trip_cells, route_cells, by_rule, ids)):
            frame.write.mode("overwrite").parquet(self._part(load, part))
        self.store.commit(LAYER, NAME, number + 1, {
            "loads": [*entry["loads"], load],
            "batches": entry["batches"] | dict.fromkeys(new, load)})
        return load

    def _cells(self, trips: DataFrame) -> DataFrame:
        return duration_cells(trips, KEYS, self.settings.get("low_speed_kmh"))

    def _routes(self, trips: DataFrame) -> DataFrame:
        return marts.route_cells(trips, ("source_hash",))

    def _summed(self, part: str, keys: tuple[str, ...], latest_only: bool) -> DataFrame:
        """Cells of all batches, or of those of the last load, by further keys than the batch."""
        _, entry = self._state()
        cells = self._read(entry, part)
        if cells is None:
            raise KeyError("no batch has been added yet")
        if latest_only:
            last = [b for b, load in entry["batches"].items() if load == entry["loads"][-1]]
            cells = cells.where(F.col("source_hash").isin(last))
        return cells.groupBy(*keys, "trip_duration").agg(
            *[F.sum(c).alias(c) for c in CELL_SUMS]).where("n <> 0")

    def marts(self, latest_only: bool = False, allow_withheld: bool = False) -> dict[str, DataFrame]:
        """The five KPI tables over all batches; with ``latest_only`` over the trips of the last load,
        which still are judged against the ids of all."""
        gate(self.settings, allow_withheld)
        cells = stored(self._summed("trip_cells", KEYS[1:], latest_only), "all-trip-cells")
        routes = self._summed("route_cells", marts.ROUTE_KEYS, latest_only)
        by_vendor = stored(cells.groupBy("vendor_id", "trip_duration").agg(
            *[F.sum(c).alias(c) for c in CELL_SUMS]), "vendor-cells")
        return {
            "trip_performance": marts.trip_performance_of(cells, self.settings, allow_withheld),
            "demand_metrics": marts.demand_of(cells),
            "geographic_metrics": marts.geographic_metrics_of(routes),
            "vendor_performance": marts.vendor_performance_of(by_vendor),
            "data_quality": self.quality(latest_only),
        }

    def quality(self, latest_only: bool = False) -> DataFrame:
        """The quality table from rows counted by the rules they fail."""
        _, entry = self._state()
        counts = self._read(entry, "rule_counts")
        if counts is None:
            raise KeyError("no batch has been added yet")
        if latest_only:
            last = [b for b, load in entry["batches"].items() if load == entry["loads"][-1]]
            counts = counts.where(F.col("source_hash").isin(last))
        return marts.data_quality_of(counts)


def _index_columns() -> list:
    """What taking a trip out again needs: its keys, measures and failed rules."""
    return ["id", "source_file", rules.FAILED, *KEYS, "trip_duration", "estimated_distance_km",
            "estimated_speed_kmh", "pickup_latitude", "pickup_longitude", "dropoff_latitude",
            "dropoff_longitude"]


def _negative(cells: DataFrame) -> DataFrame:
    return cells.withColumns({c: -F.col(c) for c in CELL_SUMS})


def latest_versions(rows: DataFrame, order: str = "ingested_at") -> DataFrame:
    """Rows without those that a later batch brings again under the same id.

    An id that one batch holds several times keeps all rows of its last batch, which stay repeated; rows
    without an id stay. ``order`` is what batches are ordered by, the file hash among equals. Ids of one
    batch alone, which is most, never take part in the join.
    """
    place = F.struct(F.col(order).alias("at"), F.col("source_hash").alias("batch"))
    spans = (rows.where("id IS NOT NULL").groupBy("id").agg(
        F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last"))
    several = stored(spans.select("id", "last"), "ids-of-several-batches")
    joined = rows.join(several, "id", "left")
    return joined.where(F.col("last").isNull() | (place == F.col("last"))).select(*rows.columns)
