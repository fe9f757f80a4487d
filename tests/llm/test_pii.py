"""Personal data: base spans against the plain patterns, and what the trees add."""

import random
import re

import pytest

from tripledger.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        d = int(c) * (2 if i % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def brute(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern in (("card", CARD), ("phone", PHONE)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if (14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def corpus(seed=4):
    draw = random.Random(seed)
    parts = ["a.b@c.de", "x@y", "@@a@b.c@d.e", "a@b.c.d@e.f", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8",
             "4111 1111 1111 1111", "4111111111111112", "+1 (559) 555-3817", "+1 (559) 555-3817 190.",
             "+12", "00.00.00.00", "1-2-3", "é", "12 34", "+49 30 1234567", "5500-0000-0000-0004", " ", "."]
    texts = ["".join(draw.choice(parts) + draw.choice(["", " ", " and ", "\n", "x"])
                     for _ in range(draw.randrange(12))) for _ in range(500)]
    return texts + ["", "é" * 10 + "a@b.co", "a" * 100_000 + "@" + "b" * 1000 + ".c", "1" * 100_000,
                    "@" * 50_000, "+" * 50_000, "1." * 50_000]


def test_base_spans_equal_the_plain_patterns():
    for text in corpus():
        got = sorted(((k, a, b) for k, a, b, fits in pii.proposals(text) if fits),
                     key=lambda s: (s[1], pii.KINDS.index(s[0])))
        if len(text) < 10_000:
            assert got == brute(text), text
    assert [p[1:3] for p in pii.proposals("a@b.co" + "a" * 100_000 + "@b.co")] == [(0, 100_006)]


@pytest.fixture(scope="module")
def found(spark):
    draw = random.Random(9)
    texts = []
    for i in range(600):
        number = "4" + "".join(draw.choice("0123456789") for _ in range(14))
        card = next(number + c for c in "0123456789" if luhn(number + c))
        texts.append(f"some words {i} here " + draw.choice([
            f"write to ann.{i}@mail{i % 7}.example.com today",
            f"host {draw.randrange(256)}.{draw.randrange(256)}.3.4 is up", f"paid by {card} then",
            f"{draw.choice(['call', 'then', 'of', 'see'])} +1 ({100 + i}) 555-{1000 + i} now", f'token = "{draw.getrandbits(160):040x}" set',
            f"released 2.{i}.1 on 2024-05-{10 + i % 20}", "we met at noon dot then"]))
    texts += ["", "mine is 4539.1488.0343.6467 ok", "ring (559) 555-3817 soon", "no numbers"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None), (None, texts[0]), (7, texts[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS id")
    return rows, pii.personal_data(docs.repartition(3)).collect(), docs


def test_base_spans_stay_and_rewritten_ones_are_added(found):
    rows, got, docs = found
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        if r.id is not None:
            assert [(s.kind, s.start, s["end"]) for s in r.spans if s.base] == brute(texts[r.id])
            ends = [(s.start, s["end"]) for s in r.spans if not s.base]
            assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    added = {texts[r.id][s.start:s["end"]] for r in got if r.id is not None for s in r.spans if not s.base}
    assert "4539.1488.0343.6467" in added and "(559) 555-3817" in added
    assert not any(a.startswith(("2.", "2024", "met at", "at noon")) for a in added)


def test_long_texts_with_many_spans_take_seconds():
    """Two megabytes with a hundred thousand spans, all accepted, and as many taken by base spans."""
    import time

    from tripledger.llm.trees import Boosted
    begin = time.perf_counter()
    base, added = pii.spans("ssn 219-09-9998 ab " * 60_000 + "a@b.co in " * 40_000, Boosted(8.0), 0.5)
    assert len(base) == 40_000 and len(added) == 60_000
    assert time.perf_counter() - begin < 60


def test_taken_spans_are_what_overlaps_say():
    draw = random.Random(8)
    held = [(a, a + draw.randrange(1, 9)) for a in (draw.randrange(300) for _ in range(30))]
    taken = pii.Taken(held)
    for _ in range(500):
        a = draw.randrange(310)
        b = a + draw.randrange(1, 7)
        assert taken.meets(a, b) == any(a < y and b > x for x, y in held)
        if not taken.meets(a, b):
            taken.add(a, b)
            held.append((a, b))


def test_secrets_and_keys_are_found(spark):
    """Recall of planted secrets: keys after a word that announces one, and identity numbers."""
    draw = random.Random(12)
    texts, planted = [], {}
    for i in range(400):
        key = pii.made(draw.choice(["key", "id"]), draw)
        before = f"words {i} of a text {draw.choice(['secret', 'api_key', 'token', 'ssn'])}: "
        texts.append(f"{before}{key} and on, mail a{i}@b.example.com")
        planted[i] = (len(before), len(before) + len(key))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: {(s.start, s["end"]) for s in r.spans} for r in pii.personal_data(docs).collect()}
    assert sum(planted[i] in got[i] for i in planted) / len(planted) > 0.9


def test_keys_have_a_digit_in_whatever_text():
    word = "abcdefghij" * 4
    assert not pii.loose(f"secret {word} here") and not pii.loose(f"secret {word} here in 1999")
    assert pii.loose(f"secret {word}7 here") == [("key", 7, 48)]


def test_empty_table_and_redaction(found, spark):
    assert pii.personal_data(found[2].limit(0)).count() == 0
    assert pii.redacted("to a@b.co now", [("email", 3, 9)]) == "to [email] now"


def test_kinds_without_a_base_pattern_are_found_and_long_keys_whole(spark):
    draw = random.Random(3)

    def text(i):
        return f"some words {i} " + draw.choice([
            f"write to ann.{i}@mail{i % 7}.example.com today", f"call +1 (559) 555-{1000 + i} now",
            f"host {draw.randrange(256)}.{draw.randrange(256)}.3.4 is up",
            f"of {pii.made('id', draw)} then", f"bank {pii.made('account', draw)} then"])
    long = "".join(draw.choice("0123456789abcdef") for _ in range(400)) + "7"
    wanted = [("id", "219-09-9998"), ("account", "DE89370400440532013000"),
              ("ip", "2001:db8:85a3:1f:2c:8a2e:370:7334"), ("key", long)]
    texts = [text(i) for i in range(600)] + [f"mine is {span} here" if kind != "key" else
                                             f"secret token {span} here" for kind, span in wanted]
    texts += ["mine is 219-00-9998 here", "mine is DE88370400440532013000 here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: [(s.kind, texts[r.id][s.start:s["end"]]) for s in r.spans]
           for r in pii.personal_data(docs).where("id >= 600").collect()}
    assert [got[600 + i] for i in range(4)] == [[w] for w in wanted]
    assert not any(k in ("id", "account") for i in (604, 605) for k, _ in got[i])


def test_candidates_without_proof_are_no_counter_examples():
    found = pii.examples("see ann (at) host dot org or (559) 555-3817")
    assert not any(f[0] in (pii.KINDS.index("email"), pii.KINDS.index("phone")) for f, _ in found)
    found = pii.examples("of 219-09-9998 and 219-00-9998, looked at noon. Then")
    assert [y for f, y in found if f[0] == pii.KINDS.index("id")] == [1, 0]
    assert [y for f, y in found if f[0] == pii.KINDS.index("email")] == [0]


def test_examples_of_all_documents_are_counted(spark):
    """22,000 documents, none of which is left out; copies of a text count as often as they are there."""
    def text(i):
        return f"words {i % 500} mail a.{i % 500}@b.example.com and 219-09-9998" if i % 20 == 0 else f"words {i}"
    docs = spark.range(22_000).rdd.map(lambda r: (r.id, text(r.id))).toDF("doc_id long, text string")
    added = spark.createDataFrame([(None, text(0))], docs.schema)
    rows = pii.scanned(docs.union(added), "doc_id", "text")
    found = pii.counted(rows)
    expected = {}
    for i in range(0, 22_000, 20):
        if i < 500:
            learned = pii.examples(text(i))
            for x, (_, y) in zip(pii.cells([f for f, _ in learned]), learned):
                expected.setdefault(x.tobytes(), [0, 0])[y] += 44
    got = {}
    for r in found.collect():
        own = got.setdefault(bytes(r.cells), [0, 0])
        own[0] += r.zeros
        own[1] += r.ones
    assert got == expected
    assert {r.apart for r in found.select("apart").distinct().collect()} == {False, True}


def test_trees_are_the_same_in_any_order_and_find_pairs(spark):
    """Group 1 is decided by two features together, group 0 the other way round; group 2 has one label."""
    import numpy as np

    from tripledger.llm import trees
    draw = np.random.default_rng(5)
    x = draw.integers(0, 8, (900, 5)).astype(np.uint8)
    x[:, 0] = np.arange(900) % 3
    label = np.where(x[:, 0] == 2, 1, ((x[:, 1] > 3) ^ (x[:, 3] > 5) ^ (x[:, 0] == 1)).astype(int))
    rows = spark.createDataFrame([(bytearray(a.tobytes()), int(1 - y), int(y)) for a, y in zip(x, label)],
                                 "cells binary, zeros bigint, ones bigint")
    models = [trees.grown(rows.repartition(n).sortWithinPartitions("cells"), 3, 5) for n in (1, 5)]
    margins = [m.margin(x) for m in models]
    assert np.array_equal(*margins)
    assert ((margins[0] > 0) == label).mean() > 0.98
    # The same sums by hand: the first round's values of group 2, whose examples are all alike.
    p = label.mean()
    n = (x[:, 0] == 2).sum()
    first = trees.Boosted(models[0].base, models[0].trees[:1]).margin(x[x[:, 0] == 2][:1])[0]
    step = trees.RATE * n * (1 - p) / (n * p * (1 - p) + trees.RIDGE)
    assert first == pytest.approx(models[0].base + step, abs=1e-2)
