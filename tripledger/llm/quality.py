"""Quality by a support vector machine over n-gram indicators scaled by naive Bayes ratios.

N-grams are over words and over word shapes, in which letters, capitals and digits are written as
classes and other characters stay: single words, single shapes, pairs of neighbouring shapes, and
the sign that a word or a line is repeated. Each n-gram that a text has counts its class log-count
ratio; the rows are scaled to length one; a linear machine with hinge loss is fitted by dual
coordinate descent; a logistic curve over margins of rows it was not fitted on makes the score.

It is fitted on at most PER_LABEL labelled rows of each label (a documented bound). Every text is
scored whole, in one pass without a shuffle.

Defined results: a null or empty text, or one without a chosen n-gram, gets the score of an empty
row; equal texts get equal scores; without labelled rows of both labels every score is 0.5; rows with
a null key are scored and never learned from; an empty table gives an empty result; only key, text
and label are read, so other columns can't clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Rolling, mixed, twice, words
from .labelled import Training, bucket, distinct, held_out, place_of, sample, scores
from .toxicity import logistic, row_sums

NGRAMS = 8192
LEAST_GAIN = 15.0
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 30
MEMO = 200_000  # words a task remembers
LETTERS = re.compile(r"[^\W\d_]+")
DIGITS = re.compile(r"\d+")


def shape(word: str) -> str:
    """Letters as a, A or Aa, digits as 0, other characters as they are."""
    def kind(run: re.Match) -> str:
        letters = run[0]
        return "a" if letters.islower() else "A" if letters.isupper() and len(letters) > 1 else "Aa"
    return DIGITS.sub("0", LETTERS.sub(kind, word))


def described(word: bytes) -> tuple[str, int]:
    """A word's shape and its hashed n-gram."""
    text = word.decode()
    return shape(text), bucket(b"w" + text.lower().encode())


def ngrams(data: np.ndarray, offsets: np.ndarray,
           memo: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, n-gram) of a block. ``memo`` keeps what was found out about words."""
    found = words(data, offsets)
    memo = {} if memo is None else memo
    if len(memo) > MEMO:
        memo.clear()
    known = []
    for word in found.vocabulary.to_pylist():
        if (entry := memo.get(word)) is None:
            entry = memo[word] = described(word)
        known.append(entry)
    index: dict[str, int] = {}
    shapes = np.array([index.setdefault(k[0], len(index)) for k in known], np.int64)
    forms = list(index)
    row, code = found.row, found.codes
    word_at = np.array([k[1] for k in known], np.int64)
    shape_at = np.array([bucket(b"s" + t.encode()) for t in forms], np.int64)
    out = [(row, word_at[code]), (row, shape_at[shapes[code]])]
    near = row[1:] == row[:-1]
    pair = shapes[code][:-1][near] * max(len(forms), 1) + shapes[code][1:][near]
    kinds, which = np.unique(pair, return_inverse=True)
    pair_at = np.array([bucket(f"p{forms[k // len(forms)]} {forms[k % len(forms)]}".encode())
                        for k in kinds.tolist()], np.int64)
    out.append((row[1:][near], pair_at[which]))
    same = near & (code[1:] == code[:-1])
    out.append((row[1:][same], np.full(same.sum(), bucket(b"r same word"))))
    # A run of eight words that the text has twice.
    if len(code) > 8:
        start = np.flatnonzero(row[8:] == row[:-8])
        again = twice(Rolling(mixed(code)).windows(8)[start] ^ mixed(row[start] + (1 << 40)))
        out.append((row[start[again]], np.full(again.sum(), bucket(b"r same run"))))
    return distinct(np.concatenate([r for r, _ in out]), np.concatenate([t for _, t in out]))


@dataclass
class Machine:
    terms: np.ndarray
    weights: np.ndarray  # of the scaled indicators; the last is the bias
    ratios: np.ndarray
    slope: float
    offset: float
    memo: dict = field(default_factory=dict)  # words met before in this task
    table: np.ndarray | None = None

    def margin(self, first: np.ndarray, index: np.ndarray) -> np.ndarray:
        values = self.ratios[index]
        length = np.sqrt(row_sums((values ** 2)[:, None], first)[:, 0])
        return (row_sums((values * self.weights[index])[:, None], first)[:, 0]
                / np.maximum(length, 1e-12) + self.weights[-1])

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.table is None:
            self.table = place_of(self.terms)
        row, term = ngrams(data, offsets, self.memo)
        column = self.table[term]
        row, column = row[column >= 0], column[column >= 0]
        first = np.searchsorted(row, np.arange(len(offsets)))
        return logistic(self.slope * self.margin(first, column) + self.offset)


def log_ratios(first, index, label, n: int) -> np.ndarray:
    """Log ratio of each n-gram's smoothed share among the rows with label 1 and with label 0."""
    row = np.repeat(np.arange(len(label)), np.diff(first))
    shares = []
    for k in (1, 0):
        count = SMOOTHING + np.bincount(index[label[row] == k], minlength=n)
        shares.append(np.log(count / (SMOOTHING * 2 + (label == k).sum())))
    return shares[0] - shares[1]


def dual_descent(first, index, values, label, cost, n: int, seed: int = 5) -> np.ndarray:
    """Weights, the bias last, of the hinge-loss machine: one dual variable at a time."""
    sign = np.where(label == 1, 1.0, -1.0)
    alpha, weights = np.zeros(len(label)), np.zeros(n + 1)
    draw = np.random.default_rng(seed)
    square = row_sums((values ** 2)[:, None], first)[:, 0] + 1.0
    for _ in range(ROUNDS):
        largest = 0.0
        for i in draw.permutation(len(label)):
            own, x = index[first[i]:first[i + 1]], values[first[i]:first[i + 1]]
            slope = sign[i] * (weights[own] @ x + weights[-1]) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            change = (new - alpha[i]) * sign[i]
            if change:
                weights[own] += change * x
                weights[-1] += change
                alpha[i] = new
                largest = max(largest, abs(change))
        if largest < 1e-3:
            break
    return weights


def logistic_fit(margin, label, weight) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with smoothed targets."""
    target = np.where(label == 1, 1 - 1e-3, 1e-3)
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = logistic(slope * margin + offset)
        d = weight * (p - target)
        h = weight * np.maximum(p * (1 - p), 1e-6)
        hessian = np.array([[h @ margin ** 2 + 1e-3, h @ margin], [h @ margin, h.sum() + 1e-3]])
        move = np.linalg.solve(hessian, np.array([d @ margin, d.sum()]))
        slope, offset = slope - np.clip(move[0], -1, 1), offset - np.clip(move[1], -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    return float(slope), float(offset)


def part(training: Training, rows: np.ndarray):
    sizes = np.diff(training.first)[rows]
    begin = np.repeat(training.first[rows] - np.cumsum(sizes) + sizes, sizes)
    first = np.concatenate([[0], np.cumsum(sizes)])
    return first, training.index[begin + np.arange(sizes.sum())], training.label[rows]


def fit(training: Training, shares: tuple[float, float]) -> Machine:
    n, label = len(training.terms), training.label
    if not len(label):
        return Machine(training.terms, np.zeros(n + 1), np.zeros(n), 1.0, 0.0)
    every = np.arange(len(label))
    first, index, own = part(training, every[every % 5 != 0])
    ratios = log_ratios(first, index, own, n)
    values = ratios[index]
    length = np.sqrt(row_sums((values ** 2)[:, None], first)[:, 0])
    values = values / np.repeat(np.maximum(length, 1e-12), np.diff(first))
    machine = Machine(training.terms, dual_descent(
        first, index, values, own, np.full(len(own), COST), n), ratios, 1.0, 0.0)
    first, index, own = part(training, every[every % 5 == 0])
    sizes = np.array([max((own == k).sum(), 1) for k in (0, 1)])
    weight = (np.array(shares) / sum(shares) / sizes)[own] * len(own)
    machine.slope, machine.offset = logistic_fit(machine.margin(first, index), own, weight)
    return machine


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4,
            value: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score) of every row, learned from the rows that are not held out."""
    use = ~held_out(F.col("id"), modulus, value)
    known = labels.select(F.col(key).alias("id"), F.col(label).alias("label")).where(use)
    count = {r.label: r["count"] for r in known.where("label IN (0, 1)").groupBy("label").count()
             .collect()}
    shares = (max(count.get(0, 0), 1), max(count.get(1, 0), 1))
    rows = sample(docs, labels, label, use, key, text)
    machine = fit(Training(rows, ngrams, NGRAMS, LEAST_GAIN), shares)
    return scores(docs, machine, key, text).select(
        "id", held_out(F.col("id"), modulus, value).alias("held_out"), "score")
