"""Whitening of embeddings by shifted Cholesky QR.

Entries become whole numbers, so sums over all rows are exact. Centred rows A are orthogonalised in
passes over the data: each pass adds up the Gram matrix of A R1^-1 ... Rk^-1, which tasks get through
triangular solves of their rows, and its Cholesky factor is R(k+1). The first Gram matrix is shifted by
a multiple of the rounding error, so that its factor exists however ill-conditioned A is; later ones
are factored with pivots and lose the directions without variance. The composed R = Rk ... R1 has the
singular values and right singular vectors of A, from which the components follow without ever taking
the eigenvectors of a covariance matrix, whose rounding would drown small ones.

A pass is one scan: tasks send one d x d matrix each, which is added in two levels, so the driver gets
about the square root of as many. Nothing is shuffled by a key, so no row or source is hot. d is the
length of a vector, which the method needs to be moderate (a matrix in memory), not bounded by a number.

Defined results: a row whose vector is null, or has a null, infinite or NaN entry, is dropped; a
vector shorter than the longest has zeros behind it; entries count as at most 2**42 in size; null and
repeated keys and repeated rows are rows like others; equal eigenvalues give orthogonal components in
some order; a direction without variance is no component, so fewer than 8 may come back, and equal or
single rows, or an empty table, give no rows; a deviation that no 64-bit number holds is null. Only the
key and the vector are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000  # fixed values: a whole number for each entry
LARGEST = 2.0**42  # of an entry
PASSES = 8
_ROWS = 8192  # rows of a block
_HALF = 26  # bits of the lower half of a whole number


def _entries(batches: Iterator[pa.RecordBatch], size: int | None = None
             ) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Keys and whole numbers of the rows that remain, in blocks; ``size`` entries a row."""
    for batch in batches:
        for at in range(0, len(batch), _ROWS):
            keys, column = (c.slice(at, _ROWS) for c in batch.columns)
            keys, column = keys.filter(column.is_valid()), column.drop_null()
            length = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            row = np.repeat(np.arange(len(length)), length)
            bad = np.zeros(len(length), bool)
            bad[row[~np.isfinite(flat)]] = True
            width = int(length.max(initial=0)) if size is None else size
            place = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
            out = np.full((len(length), width), OFFSET, np.int64)
            sound = ~bad[row]
            out[row[sound], place[sound]] = np.floor(
                SCALE * np.clip(flat[sound], -LARGEST, LARGEST)).astype(np.int64) + OFFSET
            yield keys.filter(pa.array(~bad)), out[~bad]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, and the sums of the upper and lower halves of their numbers. Vectors of different length
    are counted by length, so that the zeros behind them can be added."""
    total: dict[str, np.ndarray] = {}
    for _, x in _entries(batches):
        high = x >> _HALF
        for part, values in (("n", np.ones_like(x)), ("high", high), ("low", x - (high << _HALF))):
            total[part] = _plus(total.get(part), values.sum(0))
        total["rows"] = _plus(total.get("rows"), np.array([len(x)]))
    yield from _row(total, pa.int64())


def _plus(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    if a is None:
        return b
    if len(a) < len(b):
        a, b = b, a
    return np.concatenate([a[:len(b)] + b, a[len(b):]])


def _row(total: dict[str, np.ndarray], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row a name of this task, with the group that adds it."""
    if total:
        group = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([group] * len(total), pa.int64()), pa.array(list(total)),
             pa.array([v.tolist() for v in total.values()], pa.list_(kind))], ["task", "name", "sums"])


def _added(table: pa.Table) -> pa.Table:
    total: dict[str, np.ndarray] = {}
    for name, sums in zip(table["name"].to_pylist(), table["sums"].to_numpy()):
        total[name] = _plus(total.get(name), sums)
    kind = table.schema.field("sums").type.value_type
    return pa.table({"name": list(total), "sums": pa.array(
        [v.tolist() for v in total.values()], pa.list_(kind))})


def totals(rows: DataFrame, task: Callable, kind: str) -> dict[str, np.ndarray]:
    """What the tasks of ``task`` sum up, added in two levels."""
    partials = rows.mapInArrow(task, f"task bigint, name string, sums array<{kind}>")
    fan = max(1, int(rows.rdd.getNumPartitions() ** 0.5))
    added = partials.withColumn("task", F.pmod("task", F.lit(fan))).groupBy("task").applyInArrow(
        _added, f"name string, sums array<{kind}>")
    out: dict[str, np.ndarray] = {}
    for r in added.collect():
        out[r.name] = _plus(out.get(r.name), np.array(r.sums, object if kind == "bigint" else float))
    return out


class Centre:
    """Number of rows and exact sums; the deviations n * x - S of rows from their mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums

    def deviations(self, x: np.ndarray) -> np.ndarray:
        most = max(int(x.max(initial=0)), -int(x.min(initial=0))) * self.n
        if most + max(map(abs, self.sums), default=0) < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)

    def squares(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of squared deviations; None beyond 64 bits."""
        deviation = self.deviations(x)
        most = max(int(deviation.max(initial=0)), -int(deviation.min(initial=0)))
        if most * most * max(1, x.shape[1]) >= 1 << 63:
            deviation = deviation.astype(object)
        return [int(v) if v < 1 << 63 else None for v in (deviation * deviation).sum(1)]


def solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a r^-1 for an upper triangular r, column after column."""
    out = np.empty_like(a)
    for j in range(r.shape[1]):
        out[:, j] = (a[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


Step = tuple[np.ndarray, np.ndarray]  # the columns it keeps, and their triangular factor


def orthogonal(a: np.ndarray, steps: list[Step]) -> np.ndarray:
    for columns, r in steps:
        a = solved(a[:, columns], r)
    return a


def _gram(batches: Iterator[pa.RecordBatch], centre: Centre, steps: list[Step]):
    total: dict[str, np.ndarray] = {}
    for _, x in _entries(batches, len(centre.sums)):
        q = orthogonal(centre.centred(x), steps)
        total["gram"] = _plus(total.get("gram"), (q.T @ q).ravel())
    yield from _row(total, pa.float64())


def pivoted(gram: np.ndarray) -> tuple[Step, np.ndarray]:
    """Cholesky factor with pivots of a Gram matrix that may lack directions.

    Returns the step (columns, triangular factor of them) and the factor of all columns.
    """
    left = gram.copy()
    d = len(gram)
    tolerance = max(1e-12, d * np.finfo(float).eps) * max(1.0, left.diagonal().max(initial=0.0))
    columns: list[int] = []
    factor = np.zeros((d, d))
    for i in range(d):
        at = int(np.argmax(left.diagonal()))
        if left[at, at] <= tolerance:
            break
        factor[i] = left[at] / np.sqrt(left[at, at])
        left -= np.outer(factor[i], factor[i])
        left[at, :] = left[:, at] = 0.0
        columns.append(at)
    factor = factor[:len(columns)]
    return (np.array(columns, np.int64), np.triu(factor[:, columns])), factor


def decomposed(gram_of: Callable[[list[Step]], np.ndarray], n: int, d: int
               ) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvectors (as rows) and eigenvalues of the covariance, and its trace, from Gram passes."""
    gram = gram_of([])
    trace = float(np.trace(gram))
    if not trace:
        return np.zeros((0, d)), np.zeros(0), 0.0
    unit = np.finfo(float).eps / 2
    shift = 11 * (n * d + d * (d + 1)) * unit * np.linalg.norm(gram, 2)
    r = np.linalg.cholesky(gram + shift * np.eye(d)).T
    steps: list[Step] = [(np.arange(d), r)]
    for _ in range(PASSES):
        gram = gram_of(steps)
        step, factor = pivoted(gram)
        r = factor @ r
        if len(gram) == len(step[0]) and np.abs(gram - np.eye(len(gram))).max() < 1e-8:
            break  # orthonormal but for what the last factor puts right
        steps.append(step)
    _, sigma, vectors = np.linalg.svd(r, full_matrices=False)
    return vectors, sigma**2 / n, trace / n


def _projected(batches: Iterator[pa.RecordBatch], centre: Centre, matrix: np.ndarray):
    """Sums and products of whitened rows, to measure how white they are."""
    total: dict[str, np.ndarray] = {}
    for _, x in _entries(batches, len(centre.sums)):
        y = centre.centred(x) @ matrix
        for part, values in (("sums", y.sum(0)), ("products", (y.T @ y).ravel())):
            total[part] = _plus(total.get(part), values)
    yield from _row(total, pa.float64())


def _rows(batches: Iterator[pa.RecordBatch], centre: Centre, matrix: np.ndarray,
          explained: np.ndarray, error: float, key: str):
    k = matrix.shape[1]
    for keys, x in _entries(batches, len(centre.sums)):
        y = centre.centred(x) @ matrix
        many = len(x) * k
        yield pa.RecordBatch.from_arrays([
            keys.take(pa.array(np.repeat(np.arange(len(x)), k))),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
            pa.array(np.full(many, centre.n, np.int64)),
            pa.array(centre.squares(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))),
            pa.array(y.ravel()), pa.array(np.tile(explained, len(x))),
            pa.array(np.full(many, error))],
            [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whitened(table: DataFrame, key: str = "vec_id", vector: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for each vector
    that remains and each of the first ``components`` components by falling variance."""
    rows = table.select(F.col(f"`{key}`"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    found = totals(rows, _sums, "bigint")
    n = int(found["rows"][0]) if found else 0
    with_entry = found.get("n", [])
    # Entries that are not there count as zero, which is OFFSET as a whole number.
    sums = [int(h) * (1 << _HALF) + int(low) + (n - int(m)) * OFFSET for h, low, m in zip(
        found.get("high", []), found.get("low", []), with_entry)]
    centre = Centre(n, sums)
    d = len(sums)

    def gram_of(steps: list[Step]) -> np.ndarray:
        found = totals(rows, partial(_gram, centre=centre, steps=steps), "double")
        size = len(steps[-1][0]) if steps else d
        return found["gram"].reshape(size, size) if found else np.zeros((size, size))
    vectors, values, trace = (decomposed(gram_of, n, d) if d else
                              (np.zeros((0, 0)), np.zeros(0), 0.0))
    k = min(components, len(values))
    matrix = (vectors[:k] / np.sqrt(values[:k])[:, None]).T
    error = 0.0
    if k:
        found = totals(rows, partial(_projected, centre=centre, matrix=matrix), "double")
        mean = found["sums"] / n
        error = float(np.abs(found["products"].reshape(k, k) / n - np.outer(mean, mean)
                             - np.eye(k)).max())
    kind = dict(table.dtypes)[key]
    task = partial(_rows, centre=centre, matrix=matrix,
                   explained=values[:k] / trace if k else np.zeros(0), error=error, key=key)
    return rows.mapInArrow(task, f"`{key}` {kind}, component int, n bigint, deviation bigint, "
                                 "whitened double, explained double, identity_error double")
