"""Trips of a small fleet over one week, with one case of interest per line of CASES.

A case says which cells differ from a clean trip and which rule should reject it (None: it stays).
Everything the tests expect is counted from this list.
"""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import dataclass
from datetime import datetime, timedelta

from tripledger.sources.contract import SOURCE_COLUMNS

FIRST_DAY = datetime(2023, 5, 8)
N_CLEAN = 150


def row(number: int, **cells) -> dict:
    """A clean trip, every value drawn from its number, with some cells replaced."""
    draw = random.Random(number)
    begin = FIRST_DAY + timedelta(seconds=draw.randrange(7 * 86_400))
    length = draw.randrange(120, 2_700)
    trip = {
        "id": f"trip-{number}", "vendor_id": draw.choice("12"),
        "pickup_datetime": f"{begin}", "dropoff_datetime": f"{begin + timedelta(seconds=length)}",
        "passenger_count": str(draw.randint(1, 6)),
        "pickup_longitude": f"{draw.uniform(-74.01, -73.81):.5f}7",
        "pickup_latitude": f"{draw.uniform(40.62, 40.88):.5f}3",
        "dropoff_longitude": f"{draw.uniform(-74.01, -73.81):.5f}1",
        "dropoff_latitude": f"{draw.uniform(40.62, 40.88):.5f}9",
        "store_and_fwd_flag": draw.choice("NNNY"), "trip_duration": str(length),
    }
    return trip | cells


@dataclass(frozen=True)
class Case:
    name: str
    cells: dict
    rule: str | None = None
    geo: str | None = None
    times: int = 1


CASES = (
    Case("vendor not given", {"vendor_id": ""}, "DQ-003", times=3),
    Case("vendor nobody knows", {"vendor_id": "17"}, "DQ-003", times=2),
    Case("id of blanks", {"id": "  "}, "DQ-001", times=4),
    Case("pickup time unreadable", {"pickup_datetime": "8th of May"}, "DQ-004", times=2),
    Case("drop-off time not given", {"dropoff_datetime": ""}, "DQ-005"),
    Case("arrives the day before", {"dropoff_datetime": "2023-05-07 23:59:59"}, "DQ-006", times=2),
    Case("takes no time", {"trip_duration": "0"}, "DQ-007"),
    Case("takes minus a week", {"trip_duration": "-604800"}, "DQ-007", times=2),
    Case("duration unreadable", {"trip_duration": "ten minutes"}, "DQ-007", times=2),
    Case("takes two days", {"trip_duration": "172801"}, times=3),
    Case("bus load", {"passenger_count": "44"}, times=2),
    Case("nobody aboard", {"passenger_count": "0"}),
    Case("flag lower case", {"store_and_fwd_flag": "n"}, times=2),
    Case("flag not given", {"store_and_fwd_flag": ""}),
    Case("pickup latitude not given", {"pickup_latitude": ""}, "DQ-009", "GEO-001"),
    Case("pickup in the Atlantic", {"pickup_latitude": "0", "pickup_longitude": "0"}, "DQ-009",
         "GEO-004", times=2),
    Case("pickup beyond the pole", {"pickup_latitude": "90.25"}, "DQ-009", "GEO-002", times=2),
    Case("drop-off past the date line", {"dropoff_longitude": "-188.5"}, "DQ-010", "GEO-003"),
    Case("drop-off in Boston", {"dropoff_latitude": "42.36", "dropoff_longitude": "-71.06"},
         "DQ-010", "GEO-004", times=3),
    Case("round trip", {"pickup_latitude": "40.750003", "dropoff_latitude": "40.750003",
                        "pickup_longitude": "-73.900007", "dropoff_longitude": "-73.900007"},
         None, "GEO-005", times=5),
)
# (how often the trip stands in the first batch, in the second, whether one copy contradicts)
REPEATED = {"A": (2, 0, False), "B": (1, 2, False), "C": (2, 0, True)}


def batches() -> tuple[list[dict], list[dict]]:
    """Rows of the two deliveries."""
    first, second = [row(n) for n in range(N_CLEAN)], []
    number = N_CLEAN
    for case in CASES:
        for _ in range(case.times):
            (first if number % 3 else second).append(row(number, **case.cells))
            number += 1
    for here, there, contradicts in REPEATED.values():
        copies = [row(number) for _ in range(here)]
        if contradicts:
            copies[-1]["passenger_count"] = str(7 - int(copies[-1]["passenger_count"]))
        first += copies
        second += [row(number) for _ in range(there)]
        number += 1
    return first, second


def rows() -> list[dict]:
    first, second = batches()
    return first + second


def expected_rules() -> Counter:
    """Rows by the rule that rejects them; None counts the valid ones."""
    found = Counter({None: N_CLEAN, "DQ-002": sum(a + b for a, b, _ in REPEATED.values())})
    for case in CASES:
        found[case.rule] += case.times
    return found


def n_of(*names: str) -> int:
    """Rows of the named cases."""
    return sum(case.times for case in CASES if case.name in names)


TOTAL = len(rows())
VALID = expected_rules()[None]


def landed(spark, values=None, batch: str = "batch"):
    values = rows() if values is None else values
    data = [tuple(v[c] for c in SOURCE_COLUMNS) + (f"{batch}.csv", batch) for v in values]
    names = ", ".join(f"{c} string" for c in (*SOURCE_COLUMNS, "source_file", "source_hash"))
    return spark.createDataFrame(data, names)


def landed_batches(spark):
    first, second = batches()
    return landed(spark, first, "first").unionAll(landed(spark, second, "second"))
