"""Near-duplicate classes against all pairs of full shingle sets."""

import random
import re

import numpy as np

from tripledger.llm import near_dedup
from tripledger.llm.near_dedup import classes, keep_first

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                label[root(x)] = root(y)
    groups = {}
    for x, (i, _) in enumerate(sets):
        groups.setdefault(root(x), []).append(i)
    name = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(((i, len(s), name[root(x)]) for x, (i, s) in enumerate(sets)), key=str)


def answer(frame):
    return sorted(((r.id, r.n_shingles, r.component_id) for r in frame.collect()), key=str)


def corpus(seed=5):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, passage = [], [draw.choice(vocabulary) for _ in range(60)]

    def edited(words, rate):
        return [draw.choice(vocabulary) if draw.random() < rate else w for w in words]
    for family in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([8, 60, 300]))]
        for _ in range(draw.choice([1, 2, 8, 25])):
            rows.append(edited(base, draw.choice([0, 0.005, 0.02, 0.05])))
    chain = [draw.choice(vocabulary) for _ in range(200)]
    for _ in range(15):  # each is near the next, the ends are not near each other
        chain = edited(chain, 0.02)
        rows.append(chain)
    for _ in range(30):
        rows.append([draw.choice(vocabulary) for _ in range(40)] + passage)
    out = [" ".join(r) for r in rows]
    out += [None, "", "  \n", "one", "One", "a b c d", "A b  c d", "a b c d e", "é É", "x " * 3000]
    out += out[:5] + [" ".join(chain).upper()]
    draw.shuffle(out)
    return [(i * 7 % 1009, t) for i, t in enumerate(out)]


def test_classes_equal_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert answer(classes(docs)) == brute(rows)


def test_rest_join_alone_finds_every_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "HUB_ROUNDS", 0)
    rows = corpus(8)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert answer(classes(docs)) == brute(rows)


def test_nulls_repeated_rows_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (3, text), (3, text), (None, "q"), (None, None), (9, None), (1, text + " z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(classes(docs)) == brute(rows)
    wide = docs.selectExpr("*", "1 AS node", "'k' AS keys", "doc_id AS gone_id", "2 AS component_id")
    left = keep_first(wide)
    assert left.columns == wide.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(None, "q"), (None, None), (9, None), (1, text + " z")], key=str)  # one row of each group


def test_different_texts_under_one_key_are_judged_each_by_itself(spark):
    w, u = (" ".join(f"{c}{i}" for i in range(40)) for c in "wu")
    docs = spark.createDataFrame([(3, w), (5, w + " more"), (5, u), (5, u), (4, u + " x"), (7, None),
                                  (7, None)], "doc_id long, text string").repartition(3)
    left = sorted(((r.doc_id, r.text) for r in keep_first(docs).collect()), key=str)
    assert left == sorted([(3, w), (4, u + " x"), (7, None), (7, None)], key=str)


def test_rest_pairs_of_a_large_list_are_dealt_out(spark, monkeypatch):
    """Loose copies of one text, in parts of seven: the same classes."""
    monkeypatch.setattr(near_dedup, "HUB_ROUNDS", 0)
    monkeypatch.setattr(near_dedup, "SALTED", 7)
    draw = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(draw.choice("abc") + w if draw.random() < 0.025 else w for w in base))
            for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(classes(docs)) == brute(rows)

def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert classes(docs).count() == 0 and keep_first(docs).count() == 0


def test_shingle_sets_match_plain_sets():
    texts = ["", "a", "a b c d", "a b c d e", "A b C d e a b c d e a b c d e", "é b c d e f"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    _, first = near_dedup.shingle_sets(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert np.diff(first).tolist() == [len(shingles(t)) for t in texts]
