"""Column contract of a trip file."""

from __future__ import annotations

# Source column, typed name of its Spark type, nullable, in file order.
COLUMNS = (
    ("id", "string", False),
    ("vendor_id", "int", False),
    ("pickup_datetime", "timestamp_ntz", False),
    ("dropoff_datetime", "timestamp_ntz", False),
    ("passenger_count", "int", False),
    ("pickup_longitude", "double", False),
    ("pickup_latitude", "double", False),
    ("dropoff_longitude", "double", False),
    ("dropoff_latitude", "double", False),
    ("store_and_fwd_flag", "string", False),
    ("trip_duration", "bigint", False),
)
SOURCE_COLUMNS = tuple(name for name, _, _ in COLUMNS)
LINEAGE_COLUMNS = ("source_file", "source_hash", "ingested_at")
