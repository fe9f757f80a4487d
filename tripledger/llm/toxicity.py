"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and their beginnings of four to six letters, hashed. The machine adds
a weight for each term and, for each pair of terms, the product of their factor vectors, so a pair
such as an insult and the mention of a group can count for more than its parts. Presence counts,
not frequency.

It is fitted on at most PER_LABEL labelled rows of each label (a documented bound). A term reaches the
machine by what it tells alone, a log-likelihood ratio of LEAST_GAIN, or by what it tells in a pair:
among the FREQUENT most frequent terms and the STRONG best ones, rows of each label are counted in Spark
for every pair, and both terms of a pair that tells PAIR_GAIN more than its terms by themselves are
admitted. Only the sample's rows over the chosen terms reach the driver. Rows are weighted so that the labels have the shares they have among all labelled rows.
Every text is scored whole, in one pass without a shuffle.

Defined results: a null or empty text, or one without a chosen term, gets the score of no terms;
equal texts get equal scores; without labelled rows of both labels every score is 0.5; rows with a
null key are scored and never learned from; an empty table gives an empty result; only key, text and
label are read, so other columns can't clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import words
from .labelled import Training, bucket, distinct, held_out, sample, scores

TERMS = 4096
FREQUENT, STRONG = 512, 128  # terms of which every pair is counted
PAIR_GAIN = 45.0  # chance reaches it in one of some 10**8 pairs
LEAST_GAIN = 25.0
FACTORS = 8
STEPS = 400
RATE = 0.05
L2 = 1e-4
DENSE = 8  # one in so many rows
MEMO = 200_000  # words a task remembers
LETTERS = re.compile(r"[^\W\d_]+")


def word_terms(word: bytes) -> list[int]:
    """Hashed letters and beginnings of a word."""
    out = []
    for part in LETTERS.findall(word.decode().lower()):
        out.append(bucket(part.encode()))
        out += [bucket(f"{part[:n]}-".encode()) for n in (4, 5, 6) if len(part) >= n]
    return out


def hashed_terms(data: np.ndarray, offsets: np.ndarray,
                 of_word=word_terms) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, term) of a block, ``of_word`` being the terms of one word."""
    found = words(data, offsets, lower=True)
    lists = [of_word(word) for word in found.vocabulary.to_pylist()]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    terms = np.fromiter((t for own in lists for t in own), np.int64, counts.sum())
    first = np.concatenate([[0], np.cumsum(counts)])
    with_terms = counts[found.codes] > 0
    row, code = found.row[with_terms], found.codes[with_terms]
    own = counts[code]
    begin = np.repeat(first[code] - np.cumsum(own) + own, own)
    return distinct(np.repeat(row, own), terms[begin + np.arange(own.sum())])


@dataclass
class Machine:
    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    columns: dict = field(default_factory=dict)  # of words met before in this task

    def of_word(self, word: bytes) -> list[int]:
        """The model's columns among the word's terms."""
        found = self.columns.get(word)
        if found is None:
            if not self.columns or len(self.columns) > MEMO:
                self.columns = {None: dict(zip(self.terms.tolist(), range(len(self.terms))))}
            place = self.columns[None]
            found = [place[t] for t in word_terms(word) if t in place]
            self.columns[word] = found
        return found

    def margin(self, first: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Sum of weights and pairwise products for each row of column indexes."""
        linear = row_sums(self.weights[index][:, None], first)[:, 0]
        total = row_sums(self.factors[index], first)
        squares = row_sums(self.factors[index] ** 2, first)
        return self.bias + linear + 0.5 * (total ** 2 - squares).sum(1)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, column = hashed_terms(data, offsets, self.of_word)
        first = np.searchsorted(row, np.arange(len(offsets)))
        return logistic(self.margin(first, column))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros((len(values) + 1, values.shape[1]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


class Presence:
    """Rows of 0 and 1 by column, for sums of a few values. Columns that at least one in DENSE rows has
    are a table, as sums over their many places take several times as long; it has at most 8 * DENSE
    bytes for each place. The other columns are places only."""

    def __init__(self, first: np.ndarray, index: np.ndarray, n: int):
        self.shape = len(first) - 1, n
        row = np.repeat(np.arange(self.shape[0]), np.diff(first))
        often = np.bincount(index, minlength=n) * DENSE >= max(self.shape[0], 1)
        self.columns, place = np.flatnonzero(often), np.cumsum(often) - 1
        inside = often[index]
        self.table = np.zeros((len(self.columns), self.shape[0]))
        self.table[place[index[inside]], row[inside]] = 1
        self.row, self.index = row[~inside], index[~inside]

    def by_row(self, values: np.ndarray) -> np.ndarray:
        """Sums of each line of ``values``, one for each column, over the columns of each row."""
        rest = [np.bincount(self.row, line[self.index], self.shape[0]) for line in values]
        return values[:, self.columns] @ self.table + rest

    def by_column(self, values: np.ndarray) -> np.ndarray:
        """Sums of each line of ``values``, one for each row, over the rows of each column."""
        out = np.zeros((len(values), self.shape[1]))
        for line, own in zip(values, out):
            own += np.bincount(self.index, line[self.row], self.shape[1])
        out[:, self.columns] += values @ self.table.T
        return out


class Slope:
    """Gradient of the weighted logistic loss, with L2 on weights and factors, over given rows."""

    def __init__(self, first: np.ndarray, index: np.ndarray, n: int):
        self.rows = Presence(first, index, n)

    def __call__(self, machine: Machine, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of the bias, the weights and the factors, end to end."""
        factors = machine.factors
        sums = self.rows.by_row(np.vstack([factors.T, machine.weights, (factors ** 2).sum(1)]))
        total, linear, squares = sums[:-2], sums[-2], sums[-1]
        margin = machine.bias + linear + 0.5 * ((total ** 2).sum(0) - squares)
        error = (logistic(margin) - label) * weight
        turned = self.rows.by_column(np.vstack([error * total, error]))
        d_weights = turned[-1]
        d_factors = turned[:-1].T - d_weights[:, None] * factors
        return np.concatenate([[error.sum()], d_weights + L2 * machine.weights,
                               (d_factors + L2 * factors).ravel()])


def fit(training: Training, shares: tuple[float, float], seed: int = 3) -> Machine:
    """Weighted logistic loss, all rows in each step, Adam."""
    n, first, index, label = len(training.terms), training.first, training.index, training.label
    draw = np.random.default_rng(seed)
    machine = Machine(training.terms, 0.0, np.zeros(n), draw.normal(0, 0.05, (n, FACTORS)))
    if not len(label):
        return machine
    ones = max(int(label.sum()), 1)
    weight = np.where(label == 1, shares[1] / ones, shares[0] / max(len(label) - ones, 1))
    weight /= weight.sum()
    machine.bias = float(np.log(shares[1] / shares[0]))
    slope = Slope(first, index, n)
    state = [np.zeros(n + 1 + n * FACTORS) for _ in range(2)]
    for step in range(1, STEPS + 1):
        gradient = slope(machine, label, weight)
        state[0] += 0.1 * (gradient - state[0])
        state[1] += 0.01 * (gradient ** 2 - state[1])
        move = RATE * (state[0] / (1 - 0.9 ** step)) / (
            np.sqrt(state[1] / (1 - 0.99 ** step)) + 1e-8)
        machine.bias -= move[0]
        machine.weights -= move[1:n + 1]
        machine.factors -= move[n + 1:].reshape(n, FACTORS)
    return machine


def _pair_counts(batches, terms: np.ndarray):
    """(label, term, counts): rows of this part that have both the term and each of ``terms``."""
    total = np.zeros((2, len(terms), len(terms)), np.int64)
    for batch in batches:
        for at in range(0, len(batch), 2048):
            label, lists = (c.slice(at, 2048) for c in batch.columns)
            label = label.to_numpy(zero_copy_only=False)
            has = np.zeros((len(label), len(terms)), np.float32)
            for i, own in enumerate(lists.to_numpy(zero_copy_only=False)):
                place = np.searchsorted(terms, own)
                place[place == len(terms)] = 0
                has[i, place[terms[place] == own]] = 1
            for y in (0, 1):
                total[y] += np.rint(has[label == y].T @ has[label == y]).astype(np.int64)
    for y in (0, 1):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(terms), y, np.int32)), pa.array(np.arange(len(terms), dtype=np.int32)),
             pa.array(list(total[y]), pa.list_(pa.int64()))], ["label", "term", "counts"])


def _counts_added(table: pa.Table) -> pa.Table:
    total = np.sum(table["counts"].to_numpy(), axis=0)
    return pa.table({"label": table["label"][:1], "term": table["term"][:1],
                     "counts": pa.array([total], pa.list_(pa.int64()))})


def _told(cells: list[tuple[np.ndarray, np.ndarray]], sizes: dict[int, int]) -> np.ndarray:
    """Log-likelihood ratio of the label against cells of rows, each (rows of label 0, of label 1)."""
    rows, out = sizes[0] + sizes[1], 0.0
    for counts in cells:
        whole = counts[0] + counts[1]
        for y in (0, 1):
            expected = whole * (sizes[y] / rows)
            with np.errstate(divide="ignore", invalid="ignore"):
                out = out + 2 * np.where(counts[y] > 0, counts[y] * np.log(counts[y] / expected), 0.0)
    return out


def interplay(both: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """What each pair of terms tells beyond its two terms, of counts [label, term, term]."""
    alone = np.diagonal(both, axis1=1, axis2=2)
    single = _told([alone, [sizes[y] - alone[y] for y in (0, 1)]], sizes)
    first, second = alone[:, :, None] - both, alone[:, None, :] - both
    none = [sizes[y] - both[y] - first[y] - second[y] for y in (0, 1)]
    pair = _told([both, first, second, none], sizes)
    np.fill_diagonal(pair, 0.0)
    return pair - single[:, None] - single[None, :]


def partners(found: DataFrame, counts: DataFrame, sizes: dict[int, int], picked: list[int]) -> list[int]:
    """Terms of the pairs that tell more than their terms do."""
    often = counts.orderBy(F.desc(F.col("zeros") + F.col("ones")), "term").limit(FREQUENT)
    terms = np.array(sorted({r.term for r in often.collect()} | set(picked[:STRONG])), np.int64)
    added = found.select("label", "terms").mapInArrow(
        lambda batches: _pair_counts(batches, terms), "label int, term int, counts array<bigint>"
    ).groupBy("label", "term").applyInArrow(_counts_added, "label int, term int, counts array<bigint>")
    both = np.zeros((2, len(terms), len(terms)), np.int64)
    for r in added.collect():
        both[r.label, r.term] = r.counts
    return terms[(interplay(both, sizes) >= PAIR_GAIN).any(1)].tolist()


def learn(docs: DataFrame, labels: DataFrame, label: str, use: Column, key: str = "doc_id",
          text: str = "text") -> Machine:
    """Fit on a bounded sample of the labelled rows for which ``use`` (over ``id``) holds."""
    known = labels.select(F.col(key).alias("id"), F.col(label).alias("label")).where(use)
    count = {r.label: r["count"] for r in known.where("label IN (0, 1)").groupBy("label").count()
             .collect()}
    rows = sample(docs, labels, label, use, key, text)
    shares = (max(count.get(0, 0), 1), max(count.get(1, 0), 1))
    return fit(Training(rows, hashed_terms, TERMS, LEAST_GAIN, partners), shares)


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 5,
             value: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score) of every row, learned from the rows that are not held out."""
    machine = learn(docs, labels, label, ~held_out(F.col("id"), modulus, value), key, text)
    return scores(docs, machine, key, text).select(
        "id", held_out(F.col("id"), modulus, value).alias("held_out"), "score")
