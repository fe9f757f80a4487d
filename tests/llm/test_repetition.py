"""Repetition measures against plain counting."""

import random
import re
from collections import Counter

from tripledger.llm.repetition import COUNTS, NGRAM_LIMITS, keep_clean, measure

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    chars = sum(map(len, words))

    def covered(size, with_first):
        seen, count, hit = set(), Counter(zip(*(words[i:] for i in range(size)))), set()
        for i in range(len(words) - size + 1):
            gram = tuple(words[i:i + size])
            if count[gram] > 1 and (with_first or gram in seen):
                hit |= set(range(i, i + size))
            seen.add(gram)
        return hit
    lines, repeated, repeated_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in lines:
                repeated, repeated_chars = repeated + 1, repeated_chars + len(line)
            lines.add(line)
    again = len(covered(3, True))
    failed = len(words) < 50 or 100 * again > 50 * len(words)
    bad = repeated_chars > 0.2 * max(chars, 1) or any(
        sum(len(words[i]) for i in covered(n, False)) / max(chars, 1) > limit
        for n, limit in NGRAM_LIMITS.items())
    return (len(words), chars, sum(c in "#*$%&|<>" for c in text), repeated, again, failed,
            not failed and not bad)


def corpus():
    draw = random.Random(3)
    texts = [None, "", " \n\t ", "one", "a b c " * 40, "line one\nline one\n\n \nline one ", "é# *ß|",
             "x" * 200_000, " ".join(f"w{i}" for i in range(30_000))]
    for _ in range(60):
        small = [f"w{i}" for i in range(draw.choice([5, 30, 400]))]
        texts.append("\n".join(" ".join(draw.choice(small) for _ in range(draw.randrange(12)))
                               for _ in range(draw.randrange(30))))
    block = " ".join(f"u{i}" for i in range(70))
    texts += [block, block + "\nNotice of a licence here\n" + "more " + "Notice of a licence here",
              block + "\n" + block, "é b\x0bc\x0cd " * 20]
    return texts + texts[:3]


def test_measures_equal_plain_counting(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: tuple(r[c] for c in (*COUNTS, "base_failed", "kept"))
             for r in measure(docs).collect()}
    assert found == {i: brute(t) for i, t in enumerate(texts)}


def test_clean_rows_keep_all_columns(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i if i % 5 else None, t, "k", i * 2) for i, t in enumerate(texts)],
                                 "doc_id long, text string, kept string, n_words int")
    left = keep_clean(docs)
    assert left.dtypes == docs.dtypes
    assert sorted(r.n_words // 2 for r in left.collect()) == [
        i for i, t in enumerate(texts) if brute(t)[-1]]
    assert keep_clean(docs.limit(0)).count() == 0 and measure(docs.limit(0)).count() == 0
