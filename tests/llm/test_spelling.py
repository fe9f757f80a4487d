"""Spelling variants against a search over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tripledger.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    count = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                count[run] += 1
    n = {w: c for w, c in count.items() if c >= 5}
    form, links = {}, Counter()
    for w in n:
        found = [v for v in n if near(w, v)]
        links[w] = len(found)
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], links[w], n[form[w]] if form[w] else None)
    return out


def corpus():
    draw = random.Random(5)
    stems = ["".join(draw.choice("abcdeé×o") for _ in range(draw.randrange(5, 11))) for _ in range(60)]
    rows = []
    for i in range(400):
        words = []
        for _ in range(60):
            w = draw.choice(stems[:1 + draw.randrange(60)])
            for _ in range(draw.choice([0, 0, 0, 1, 1, 2])):
                at, kind = draw.randrange(len(w)), draw.randrange(3)
                w = w[:at] + ("" if kind == 0 else draw.choice("abé")) + w[at + (kind != 1):]
            words.append(w.upper() if draw.random() < 0.1 and "é" not in w else w)
        rows.append((i if i % 50 else None, " 1-".join(words)))
    rows += [(1000 + i, f"{w} " * n) for i, (w, n) in enumerate(
        (("chainooo", 7), ("chainooy", 40), ("chainoyy", 220)))]
    long_word = "b" * 120 + "a" * 400
    rows += [(7, None), (8, ""), (9, " \n"), (10, f"{long_word} {long_word}é x" * 6),
             (10, f"{long_word} {long_word}é x" * 6), (11, "short " * 30), (11, "shorts shortz " * 9)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "w", 1) for k, t in rows],
                                 "doc_id long, text string, word string, n int").repartition(3)


def test_variants_equal_a_search_over_all_pairs(spark):
    rows = corpus()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n)
             for r in spelling.variants(frame(spark, rows)).collect()}
    wanted = brute(rows)
    assert found == wanted
    assert any(root != form for form, root, *_ in wanted.values() if form)


def test_small_subtrees_and_parts_give_the_same(spark):
    rows = corpus()
    vocabulary = spelling.words(frame(spark, rows))
    whole = {tuple(r) for r in spelling.near_words(vocabulary).collect()}
    assert whole == {tuple(r) for r in spelling.near_words(vocabulary, 7, 9).collect()}
    assert len(whole) == len(brute(rows))


def test_a_leaf_of_many_anagrams(spark):
    """Words of one vector are dealt out by hash; their near words are still all found."""
    draw = random.Random(2)
    words = sorted({"".join(draw.sample("abcdefgh", 8)) for _ in range(150)})
    words += [w[:3] + "e" + w[3:] for w in words[:40]]
    vocabulary = spark.createDataFrame([(w, i + 5) for i, w in enumerate(words)], "word string, n long")
    found = {r.word: r.n_near for r in spelling.near_words(vocabulary, 16, 32).collect()}
    assert found == {w: sum(near(w, v) for v in words) for w in words}


def test_no_words(spark):
    for rows in ([], [(1, None), (2, ""), (None, "abc defgh")]):
        assert spelling.variants(frame(spark, rows)).collect() == []


def test_letters_are_code_points():
    flat, offsets = spelling.letters(pa.array(["aé", "", "ÿÀz"]))
    assert bytes(flat).decode("latin-1") == "aéÿÀz" and offsets.tolist() == [0, 2, 2, 5]
    assert spelling.vectors(flat, offsets).sum(1).tolist() == [2, 0, 3]
    a, b = np.array([0, 1]), np.array([1, 2])
    text, at = spelling.letters(pa.array(["abc" * 20, "abc" * 20 + "d", "abd" + "abc" * 19 + "d"]))
    assert spelling.one_apart(text, at, a, b).tolist() == [True, True]
