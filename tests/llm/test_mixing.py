"""Poisson replication against the distribution and a plain inversion."""

import hashlib
import math
from collections import Counter

import pytest

from tripledger.llm.mixing import MAX_MEAN, TEMPERATURE, mixed_rows, most_copies, replicated, shares


def rows(n=3000):
    return [(i, f"text {i}", "rare" if i % 100 == 99 else "big" if i % 10 < 8 else "mid")
            for i in range(n)]


def plain_means(sizes, cap=MAX_MEAN):
    """Means by taking sources to the limit one after the other."""
    at_limit = set()
    while True:
        rows = sum(sizes.values()) - cap * sum(sizes[s] for s in at_limit)
        mass = sum(n ** TEMPERATURE for s, n in sizes.items() if s not in at_limit)
        means = {s: cap if s in at_limit else n ** TEMPERATURE / mass * rows / n
                 for s, n in sizes.items()}
        worst = max(means, key=means.get)
        if means[worst] <= cap:
            return means
        at_limit.add(worst)


def expected(data):
    sizes = Counter(s for _, _, s in data)
    means = plain_means(sizes) if data else {}
    out = Counter()
    for i, text, source in data:
        mean = means[source]
        whole = f"7:{'' if i is None else i}:{text or ''}"
        number = int(hashlib.md5(whole.encode()).hexdigest()[:13], 16) / 2 ** 52
        k, reached = 0, math.exp(-mean)
        while number >= reached and k < 32:
            k += 1
            reached += math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1))
        out[(i, text, source)] += k
    return {r: n for r, n in out.items() if n}


def test_counts_equal_plain_inversion_and_shares_move_to_the_target(spark):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)
    found = Counter(tuple(r) for r in mixed_rows(docs).collect())
    assert found == expected(data)
    sizes, got = Counter(s for *_, s in data), Counter(s for (*_, s) in found.elements())
    assert got["rare"] / sizes["rare"] > 2 > got["big"] / sizes["big"]


@pytest.mark.parametrize("cap", [MAX_MEAN, 1.5, 60.0])
def test_targets_hold_with_a_limit_of_the_mean(spark, cap):
    """Tiny sources reach the limit; what it takes from them goes to the others."""
    data = [(i, f"text {i}", "big" if i < 20_000 else f"s{i % 7}" if i < 20_400 else f"t{i % 40}")
            for i in range(20_600)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    sizes = Counter(s for *_, s in data)
    want = plain_means(sizes, cap)
    found = {r.source: r for r in shares(docs, max_mean=cap).collect()}
    assert {s: r.rows for s, r in found.items()} == sizes
    for source, r in found.items():
        assert r.mean == pytest.approx(want[source], rel=1e-9)
        assert r.target == pytest.approx(want[source] * r.rows / len(data), rel=1e-9)
        assert abs(r.reached - r.target) < 0.01 + 0.2 * r.target
    assert sum(r.target for r in found.values()) == pytest.approx(1)
    assert sum(r.copies for r in found.values()) == pytest.approx(len(data), rel=0.05)
    mean, limit = max(want.values()), most_copies(cap)
    tail = 1 - sum(math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)) for k in range(limit))
    assert tail < 1e-12


def test_order_is_a_hash_order(spark):
    docs = spark.createDataFrame(rows(500), "doc_id long, text string, source string")
    found = replicated(docs).collect()
    assert len({r.place for r in found}) == len(found)
    assert all(1 <= r.copy <= r.copies for r in found)
    order = [r.row.doc_id for r in found]
    assert order != sorted(order)


def test_nulls_ties_empty_texts_and_clashing_columns(spark):
    data = [(None, None, None), (1, "", None), (1, "", None), (None, "x" * 200_000, "a"), (2, "b", "")]
    docs = (spark.createDataFrame(data, "doc_id long, text string, source string")
            .selectExpr("*", "1 AS copies", "'p' AS place", "2 AS row", "3 AS number"))
    found = mixed_rows(docs)
    assert found.dtypes == docs.dtypes
    assert Counter(tuple(r)[:3] for r in found.collect()) == Counter(
        {r: n for r, n in expected([(i, t, s if s is None else s) for i, t, s in data]).items()})
    assert mixed_rows(docs.limit(0)).count() == 0
