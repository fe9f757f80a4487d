"""Toxicity and quality: accuracy on rows that were held out, and odd rows."""

import random
import zlib

import numpy as np
import pytest

from tripledger.llm.quality import quality
from tripledger.llm.toxicity import toxicity

WORDS = [f"{a}{b}{c}" for a in ("ba", "do", "ki", "mu") for b in ("re", "lo", "si", "ta", "vo")
         for c in ("n", "st", "m", "ra")]


def corpus(seed=2, n=900):
    draw = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [draw.choice(WORDS) for _ in range(draw.randrange(20, 120))]
        toxic, good = draw.random() < 0.3, draw.random() < 0.6
        if toxic:
            words.insert(draw.randrange(len(words)), "Vermin" + draw.choice(["", "s", "ous", "."]))
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else [f"{w}***" for w in words]
        rows.append((i, " ".join(words)))
        if i % 10:
            labels.append((i, int(good), int(toxic)))
    rows += [(None, "lone Vermin text"), (None, None), (n, ""), (n + 1, "x" * 300_000), (3, rows[3][1])]
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS id", "1 AS score")
    marks = spark.createDataFrame(labels + [(5, None, None), (None, 1, 1)],
                                  "doc_id long, quality int, toxic int")
    return rows, {i: (q, t) for i, q, t in labels}, docs.repartition(3), marks


@pytest.mark.parametrize("operator,which,modulus,value,least", [(toxicity, 1, 5, 0, 0.5),
                                                               (quality, 0, 4, 2, 0.7)])
def test_held_out_rows(tables, operator, which, modulus, value, least):
    rows, labels, docs, marks = tables
    found = operator(docs, marks).collect()
    assert len(found) == len(rows)
    right = []
    for r in found:
        assert 0 <= r.score <= 1
        held = r.id is not None and zlib.crc32(str(r.id).encode()) % modulus == value
        assert r.held_out == held
        if held and r.id in labels and r.id != 5:
            right.append((r.score >= least) == bool(labels[r.id][which]))
    assert len(right) > 100 and np.mean(right) > 0.97
    twins = [r.score for r in found if r.id == 3]
    assert len(twins) == 2 and twins[0] == twins[1]


def test_a_label_that_only_a_pair_explains(spark):
    """Toxic texts have exactly one of two words, each of which is as common in the others."""
    draw = random.Random(6)
    rows, labels = [], []
    for i in range(3000):
        words = [draw.choice(WORDS) for _ in range(25)]
        a, b = draw.random() < 0.5, draw.random() < 0.5
        words[:0] = ["gruppe"] * a + ["vermin"] * b
        draw.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(a != b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = [(r.score >= 0.5) == bool(labels[r.id][1]) for r in toxicity(docs, marks).collect()
            if r.held_out]
    assert len(held) > 400 and np.mean(held) > 0.9


def test_margin_and_gradient_equal_plain_sums():
    """The margin by all pairs, and one step down by differences of the loss."""
    from tripledger.llm.toxicity import L2, Machine, Slope, interplay, logistic
    draw = np.random.default_rng(3)
    terms, factors = 7, draw.normal(size=(7, 8))
    machine = Machine(np.arange(terms), 0.3, draw.normal(size=terms), factors)
    rows = [[0, 2, 5], [], [1], [0, 1, 2, 3, 4, 5, 6]]
    first = np.cumsum([0, *map(len, rows)])
    index = np.array([i for r in rows for i in r])
    plain = [0.3 + sum(machine.weights[i] for i in r)
             + sum(factors[i] @ factors[j] for i in r for j in r if i < j) for r in rows]
    assert np.allclose(machine.margin(first, index), plain)
    assert np.allclose(logistic(np.array([0.0, 100.0])), [0.5, 1.0])
    label, weight = np.array([1, 0, 1, 0]), np.array([0.1, 0.4, 0.2, 0.3])

    def loss(values):
        other = Machine(np.arange(terms), values[0], values[1:8], values[8:].reshape(7, 8))
        p = logistic(other.margin(first, index))
        return (-(weight * np.where(label == 1, np.log(p), np.log(1 - p))).sum()
                + L2 / 2 * (values[1:] ** 2).sum())
    at = np.concatenate([[0.3], machine.weights, factors.ravel()])
    steps = np.eye(len(at)) * 1e-5
    differences = [(loss(at + s) - loss(at - s)) / 2e-5 for s in steps]
    assert np.allclose(Slope(first, index, terms)(machine, label, weight), differences, atol=1e-7)
    # A pair tells what its two terms don't: counted over single rows.
    label = draw.integers(0, 2, 400)
    has = draw.integers(0, 2, (400, 3))
    has[:, 2] = has[:, 0] ^ label
    both = np.stack([has[label == y].T @ has[label == y] for y in (0, 1)])
    found = interplay(both, {0: int((label == 0).sum()), 1: int((label == 1).sum())})
    assert found[0, 2] > 300 and abs(found[0, 1]) < 20 and found[0, 2] == pytest.approx(found[2, 0])


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_empty_tables(tables, operator):
    _, _, docs, marks = tables
    assert operator(docs.limit(0), marks).count() == 0
    assert {r.score for r in operator(docs, marks.limit(0)).collect()} == {0.5}


def test_steps_over_a_full_sample_take_tenths_of_a_second():
    """16,000 rows of 140 terms, most of them among 500 frequent ones, against sums over a whole table."""
    import time

    from tripledger.llm.toxicity import L2, Machine, Slope, logistic
    draw = np.random.default_rng(8)
    rows, terms = 16_000, 1900
    has = draw.random((rows, terms)) < np.where(np.arange(terms) < 500, 0.25, 0.01)
    has[7] = False
    first, index = np.concatenate([[0], np.cumsum(has.sum(1))]), np.nonzero(has)[1]
    label, weight = draw.integers(0, 2, rows), np.full(rows, 1 / rows)
    machine = Machine(np.arange(terms), -1.0, draw.normal(0, 0.05, terms),
                      draw.normal(0, 0.05, (terms, 8)))
    slope = Slope(first, index, terms)
    begin = time.perf_counter()
    for _ in range(5):
        got = slope(machine, label, weight)
    assert time.perf_counter() - begin < 3
    total = has @ machine.factors
    margin = -1 + has @ machine.weights + ((total ** 2) - has @ machine.factors ** 2).sum(1) / 2
    error = (logistic(margin) - label) * weight
    d_weights = has.T @ error
    d_factors = has.T @ (error[:, None] * total) - d_weights[:, None] * machine.factors
    assert np.allclose(got, [error.sum(), *(d_weights + L2 * machine.weights),
                             *(d_factors + L2 * machine.factors).ravel()], atol=1e-12)
