"""Gradient-boosted trees with logistic loss, grown by Spark jobs over all examples.

An example is a row of cells, one byte below CELLS for each feature, with the numbers of examples of
label 0 and of label 1 that have these cells. The first cell is its group. A round adds a tree for each
group. For each level of a round's trees one job adds up gradients and curvatures by node, feature and
cell; only these sums reach the driver, at most groups x nodes x features x CELLS of them whatever the
number of examples, and the best cut of each node is taken from them. They are sums of whole numbers of
UNIT, so the trees are the same in any order of rows and any number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import settings

CELLS = 32
DEPTH = 3
ROUNDS = 20
RATE = 0.3
RIDGE = 1.0
LEAST_GAIN = 1e-6
UNIT = 1 << 20
NEVER = 255  # a cut that no cell is beyond

Levels = tuple[np.ndarray, np.ndarray]


@dataclass
class Boosted:
    """For each round feature and cut by group and inner node, and value by group and leaf."""

    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            out += value[x[:, 0], nodes(x, (feature, cut), DEPTH)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -60, 60)))


def nodes(x: np.ndarray, tree: Levels, levels: int) -> np.ndarray:
    """The node of each row after so many levels, from 0 on in each level."""
    feature, cut = tree
    row, group, node = np.arange(len(x)), x[:, 0], np.zeros(len(x), np.int64)
    for level in range(levels):
        at = (1 << level) - 1 + node
        node = 2 * node + (x[row, feature[group, at]] > cut[group, at])
    return node


def matrix(column: pa.Array, features: int) -> np.ndarray:
    """A column of cells as a matrix of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, features)


def _sums(batches: Iterator[pa.RecordBatch], model: Boosted, tree: Levels, level: int, groups: int,
          features: int) -> Iterator[pa.RecordBatch]:
    size = (groups << level) * features * CELLS
    total = np.zeros((2, size))
    for batch in batches:
        x = matrix(batch.column(0), features)
        zeros, ones = (batch.column(i).to_numpy() for i in (1, 2))
        p, n = model.score(x), zeros + ones
        node = (x[:, 0].astype(np.int64) << level) + nodes(x, tree, level)
        place = ((node[:, None] * features + np.arange(features)) * CELLS + x).ravel()
        for k, amount in enumerate((p * n - ones, np.maximum(p * (1 - p), 1e-6) * n)):
            total[k] += np.bincount(place, np.repeat(np.rint(amount * UNIT), features), size)
    found = np.flatnonzero(total.any(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(found), *(pa.array(t[found].astype(np.int64)) for t in total)], ["place", "g", "h"])


def _worth(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _cuts(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, cut and values of both sides for each node, of sums [node, feature, cell]."""
    left_g, left_h = np.cumsum(g, 2), np.cumsum(h, 2)
    whole_g, whole_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
    gain = (_worth(left_g, left_h) + _worth(whole_g - left_g, whole_h - left_h)
            - _worth(whole_g, whole_h)).reshape(len(g), -1)
    best = gain.argmax(1)
    split = gain[np.arange(len(g)), best] > LEAST_GAIN
    feature = np.where(split, best // CELLS, 0)
    cut = np.where(split, best % CELLS, NEVER)
    at = np.arange(len(g)), feature, np.where(split, cut, CELLS - 1)
    low_g, low_h = left_g[at], left_h[at]
    values = [-RATE * g / (h + RIDGE) for g, h in
              ((low_g, low_h), (whole_g[:, 0, 0] - low_g, whole_h[:, 0, 0] - low_h))]
    return feature, cut, np.stack(values, 1)


def grown(examples: DataFrame, groups: int, features: int) -> Boosted:
    """Trees over all of the (cells, zeros, ones)."""
    zeros, ones = (n or 0 for n in examples.agg(F.sum("zeros"), F.sum("ones")).first())
    if not zeros or not ones:
        return Boosted(8.0 if ones else -8.0)
    model = Boosted(float(np.log(ones / zeros)))
    with settings(examples.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000"}):
        for _ in range(ROUNDS):
            feature = np.zeros((groups, (1 << DEPTH) - 1), np.int64)
            cut = np.full(feature.shape, NEVER)
            for level in range(DEPTH):
                parts = examples.select("cells", "zeros", "ones").mapInArrow(
                    lambda batches, tree=(feature, cut), level=level: _sums(
                        batches, model, tree, level, groups, features),
                    "place bigint, g bigint, h bigint")
                found = parts.groupBy("place").agg(F.sum("g"), F.sum("h")).toArrow()
                sums = np.zeros((2, (groups << level) * features * CELLS))
                sums[:, found.column(0).to_numpy()] = [found.column(k).to_numpy() for k in (1, 2)]
                own_feature, own_cut, value = _cuts(
                    *(sums / UNIT).reshape(2, groups << level, features, CELLS))
                inner = slice((1 << level) - 1, (2 << level) - 1)
                feature[:, inner] = own_feature.reshape(groups, -1)
                cut[:, inner] = own_cut.reshape(groups, -1)
            model.trees.append((feature, cut, value.reshape(groups, -1)))
    return model
