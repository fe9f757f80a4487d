"""Bounded samples of labelled rows, hashed terms of texts, and the choice of terms that tell."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import blocks
from .store import stored

BUCKETS = 1 << 20
PER_LABEL = 8000


def remainder(key: Column, modulus: int) -> Column:
    """CRC-32 of the key written as text, modulo ``modulus``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def held_out(key: Column, modulus: int, value: int) -> Column:
    return F.coalesce(remainder(key, modulus) == value, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, key: str = "doc_id",
           text: str = "text", per_label: int = PER_LABEL) -> DataFrame:
    """(label, text) of at most ``per_label`` labelled keys of each of the labels 0 and 1, the first
    by a hash, among those for which ``learn`` holds. Rows without key or label are not used."""
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label"))
    able = known.where(learn & F.col("id").isNotNull())
    few = first_by_hash(able.where("label = 0"), "id", per_label).union(
        first_by_hash(able.where("label = 1"), "id", per_label))
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return texts.join(F.broadcast(few), "id").select("label", "text")


def bucket(term: bytes) -> int:
    """The place of a hashed term."""
    import zlib

    return (zlib.crc32(term) * 0x9E3779B1 >> 7) % BUCKETS


def first_by_hash(rows: DataFrame, key: str, n: int, seed: int = 11) -> DataFrame:
    """The ``n`` rows with the smallest hash of their key, or all if there are fewer.

    About 2 n rows are below the cut that the number of rows gives, so the sort is of those alone.
    """
    total, half = rows.count(), 1 << 62
    order = F.shiftright(F.xxhash64(key, F.lit(seed)), 1) + half  # from 0 up to 2 * half
    ordered = rows.withColumn("hashed", order)
    if total > 8 * n:
        ordered = ordered.where(F.col("hashed") < int(2 * half * (2 * n / total)))
    return ordered.orderBy("hashed", key).limit(n).drop("hashed")


Terms = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def distinct(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs without repetition, in order of row and term."""
    both = np.unique(row * BUCKETS + term)
    return both // BUCKETS, both % BUCKETS


def _rows_of_terms(batches: Iterator[pa.RecordBatch], terms: Terms):
    for rows, data, offsets in blocks(batches, "text"):
        row, term = terms(data, offsets)
        first = np.searchsorted(row, np.arange(len(rows) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.ListArray.from_arrays(pa.array(first),
                                                      pa.array(term.astype(np.int32)))],
            ["label", "terms"])


def term_counts(found: DataFrame) -> DataFrame:
    """(term, zeros, ones): rows of each label that have the term."""
    return found.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.when(F.col("label") == 0, 1)).alias("zeros"),
        F.count(F.when(F.col("label") == 1, 1)).alias("ones"))


def chosen(counts: DataFrame, sizes: dict[int, int], n: int, least: float) -> DataFrame:
    """The ``n`` of the counted terms whose presence tells most about the label, by a log-likelihood
    ratio of ``least`` or more."""
    rows = sizes[0] + sizes[1]

    def part(have: Column, expected: Column) -> Column:
        return F.when(have > 0, have * F.log(have / expected)).otherwise(0.0)
    seen = F.col("zeros") + F.col("ones")
    gain = 2 * sum(
        (part(F.col(c), seen * F.lit(sizes[k] / rows))
         + part(sizes[k] - F.col(c), (rows - seen) * F.lit(sizes[k] / rows))
         for k, c in ((0, "zeros"), (1, "ones"))), F.lit(0.0))
    return (counts.withColumn("gain", gain).where(F.col("gain") >= least)
            .orderBy(F.desc("gain"), "term").limit(n))


def _only(batches: Iterator[pa.RecordBatch], terms: np.ndarray):
    """The rows with only the given terms left, in order."""
    for batch in batches:
        lists = [t[np.isin(t, terms)] for t in
                 batch.column(1).to_numpy(zero_copy_only=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lists, pa.list_(pa.int32())), batch.column(2)],
            ["label", "terms", "order"])


class Training:
    """The sample as sparse rows over the chosen terms, small enough for the driver."""

    def __init__(self, rows: DataFrame, terms: Terms, n: int, least: float,
                 more: Callable[[DataFrame, DataFrame, dict[int, int], list[int]], list[int]]
                 | None = None):
        """``more`` may name further terms, from the rows of terms, their counts, the number of rows of
        each label, and the chosen terms from the best on."""
        found = stored(rows.mapInArrow(lambda batches: _rows_of_terms(batches, terms),
                                       "label int, terms array<int>"), "labelled-terms")
        sizes = {0: 0, 1: 0} | {r.label: r["count"] for r in found.groupBy("label").count().collect()}
        picked = []
        if sizes[0] and sizes[1]:
            counts = stored(term_counts(found), "term-counts")
            picked = [r.term for r in chosen(counts, sizes, n, least).collect()]
            if more:
                picked += more(found, counts, sizes, picked)
        self.terms = np.array(sorted(set(picked)), np.int64)
        terms = self.terms
        kept = found.select("label", "terms", F.hash("terms").alias("order")).mapInArrow(
            lambda batches: _only(batches, terms),
            "label int, terms array<int>, order int").toPandas() if picked else None
        if kept is None:
            self.label, self.first, self.index = (np.zeros(0, np.int64), np.zeros(1, np.int64),
                                                  np.zeros(0, np.int64))
            return
        # A fixed order, whatever order the rows came in.
        kept["size"] = kept["terms"].map(len)
        kept = kept.sort_values(["order", "label", "size"], kind="stable")
        self.label = kept["label"].to_numpy(np.int64)
        lists = [np.searchsorted(self.terms, np.sort(np.asarray(t, np.int64))) for t in kept["terms"]]
        self.first = np.concatenate([[0], np.cumsum([len(t) for t in lists])]).astype(np.int64)
        self.index = np.concatenate(lists) if lists else np.zeros(0, np.int64)


def place_of(terms: np.ndarray) -> np.ndarray:
    """A table from bucket to column of the model, -1 where a bucket isn't used."""
    table = np.full(BUCKETS, -1, np.int32)
    table[terms] = np.arange(len(terms))
    return table


def scores(docs: DataFrame, score: Callable, key: str, text: str) -> DataFrame:
    """(id, score): ``score(data, offsets)`` of each row's whole text, to nine digits, so that the order
    of additions in a block doesn't tell equal texts apart."""
    kind = dict(docs.dtypes)[key]

    def run(batches):
        for rows, data, offsets in blocks(batches, "text"):
            found = np.round(score(data, offsets).astype(np.float64), 9)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found)], ["id", "score"])
    return (docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(run, f"id {kind}, score double"))
