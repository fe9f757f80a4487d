"""Exact deduplication against a plain grouping by text."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tripledger.llm.exact_dedup import groups_of_equals, keep_one

ROWS = [(1, "a b"), (2, "a b"), (3, "A b"), (4, ""), (5, None), (6, " a b"), (7, "x" * 300_000),
        (8, "x" * 300_000), (9, "x" * 299_999 + "y"), (10, "é"), (11, "é"), (12, "a b"),
        (12, "a b"), (None, "a b"), (None, "lone"), (None, "z"), (None, "z")]


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, keep, len(ids), digest) for i in ids]
    return sorted(out, key=str)


def answer(frame):
    return sorted(((r.id, r.keep_id, r.group_size, r.digest.hex()) for r in frame.collect()), key=str)


def test_groups_equal_grouping_by_text(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    got = groups_of_equals(docs, files_per_batch=1)  # several small batches over the same state
    assert answer(got) == expected(ROWS)
    assert got.where("kept").count() == len({t or "" for _, t in ROWS})


def test_a_weak_digest_is_settled_by_the_bytes(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    weak = groups_of_equals(docs, digest=lambda t: F.encode(F.substring(t, 1, 1), "utf-8"))
    got = sorted(((r.id, r.keep_id, r.group_size) for r in weak.collect()), key=str)
    assert got == sorted((r[:3] for r in expected(ROWS)), key=str)


def test_one_row_of_each_group_stays_with_all_columns(spark):
    docs = (spark.createDataFrame(ROWS, "doc_id long, text string")
            .withColumns({"digest": F.lit("own"), "keep": F.lit(None).cast("int"),
                          "rest": F.array("doc_id"), "place": F.lit(1.5)}))
    got = keep_one(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    rows = got.collect()
    assert sorted(r.text or "" for r in rows) == sorted({t or "" for _, t in ROWS})
    assert {r.doc_id for r in rows if r.text == "a b"} == {12}
    assert {(r.digest, r.place) for r in rows} == {("own", 1.5)}
    assert [r.text for r in rows if r.doc_id == 5] == [None]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert groups_of_equals(docs).count() == 0
    assert keep_one(docs).count() == 0
