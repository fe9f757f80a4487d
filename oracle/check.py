"""Compare queries with their DuckDB statements: python -m oracle.check SF_DIR [query ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from oracle.answers import ANSWERS
from tripledger.catalog import QUERIES
from tripledger.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value) -> str:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def bag(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def compare(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """'' when rows and types agree, else the first difference."""
    relation = con.sql(sql)
    theirs = bag(relation.columns, relation.fetchall())
    types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    ours_types = {c: KINDS.get(t, t) for c, t in frame.dtypes}
    if ours_types != types:
        return f"schema {sorted(set(ours_types.items()) ^ set(types.items()))}"
    ours = bag(frame.columns, frame.collect())
    if ours != theirs:
        extra = [r for r in ours if r not in set(theirs)][:2]
        missing = [r for r in theirs if r not in set(ours)][:2]
        n = len(set(ours) - set(theirs))
        return (f"rows {len(ours)} and {len(theirs)}, {n} differ; {sorted(frame.columns)}"
                f" only here {extra}, only there {missing}")
    return ""


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session(), connect(sf_dir), 0
    for name in names:
        start = time.time()
        if name not in ANSWERS:
            rows = QUERIES[name](spark, sf_dir).count()
            print(f"rows  {name} {rows} ({time.time() - start:.1f}s)", flush=True)
            continue
        try:
            problem = compare(QUERIES[name](spark, sf_dir), con, ANSWERS[name])
        except Exception as error:  # report and go on
            problem = str(error)[:700].replace("\n", " ")
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok'}  {name} ({time.time() - start:.1f}s) {problem[:1200]}",
              flush=True)
    print(f"{bad} of {len(names)} differ")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
