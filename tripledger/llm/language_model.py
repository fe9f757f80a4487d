"""Language-model scores of whole documents by a gated recurrent network trained on the corpus.

Counts of all tokens of all training documents are taken in Spark. The LISTED most frequent words
travel with the tasks; each has an input row of its own and a learned place among the choices in its
class, and the classes go by frequency. Every other word keeps its exact count in a table that texts
are joined with. The network is trained in PASSES passes, each over its own part of the training
documents, so that every token is learned from once: each task does truncated back-propagation over
its documents from the common weights, which then change by the mean of the tasks' changes, weighted
by the number of their tokens. Scores are then taken in one pass.

A documented cut: a word beyond the list is fed in as its form (FORMS of them), and the context tells
such words apart by form only. It has the probability of its form times its share in it,
(count + 1) / (sum over the class of (count + 1) + 1), where the last 1 stands for all words of the
class that the training documents don't have. So probabilities add up to one.

Defined results: a null or empty text is one end token; without training documents the counts are
zero and the untrained network gives its frequencies; equal texts get equal scores up to the order of
additions; repeated rows are rows of their own; rows with a null key are never held out; an empty
table gives an empty result; texts are read whole; only key and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import blocks, release_memory, words
from .gru import RATE, Layout, Network, Tokens, Trainer, log_likelihood, start
from .labelled import held_out
from .store import settings, stored

LISTED = 131_072
HEAD_CLASSES = 256
FORMS = 17 * 4
PASSES = 4
BLOCK = 6_000_000
LEARN_BLOCK = 8_000_000  # bytes of text whose documents share the lanes of the training
TASK_TOKENS = 2_000_000  # a pass has a task for so many tokens: each of them writes all weights
REDUCERS = 8
PIECE = 1 << 18  # weights travel in pieces of so many numbers
END = b""


_KIND = np.array([1 if b == 46 else 2 if b == 44 else 0 if b >= 128 or chr(b).isalnum() else 3
                  for b in range(256)], np.int32)


def forms(vocabulary: pa.Array) -> np.ndarray:
    """The class of each word by its form: the first letter beyond ASCII, and the kind of the last byte."""
    if not len(vocabulary):
        return np.zeros(0, np.int32)
    vocabulary = vocabulary.cast(pa.large_binary())
    _, places, data = vocabulary.buffers()
    at = np.frombuffer(places, np.int64)[vocabulary.offset:][:len(vocabulary) + 1]
    data = np.frombuffer(data, np.uint8)[:at[-1]]
    accent = np.zeros(len(vocabulary), np.int32)
    letters = at[0] + np.flatnonzero(data[at[0]:] >= 0xC0)[::-1]
    word = np.searchsorted(at, letters, side="right") - 1
    inner = letters + 1 < at[word + 1]
    accent[word[inner]] = 1 + data[letters[inner] + 1] % 16  # backwards, so that the first one stays
    return accent * 4 + _KIND[data[at[1:] - 1]]


def form(word: bytes) -> int:
    return int(forms(pa.array([word], pa.large_binary()))[0])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, form, n) for each block; the end of a document is the empty word."""
    for rows, data, offsets in blocks(batches, "text", BLOCK):
        found = words(data, offsets, lower=True)
        n = np.bincount(found.codes, minlength=len(found.vocabulary))
        listed = pa.concat_arrays([found.vocabulary.cast(pa.binary()), pa.array([END], pa.binary())])
        yield pa.RecordBatch.from_arrays(
            [listed.cast(pa.string()), pa.array(np.append(forms(found.vocabulary), np.int32(-1))),
             pa.array(np.append(n, len(rows)).astype(np.int64))], ["word", "form", "n"])


def counts(training: DataFrame) -> DataFrame:
    """(word, form, c): how often each token occurs in the training documents."""
    return (training.select("text").mapInArrow(_counted, "word string, form int, n bigint")
            .groupBy("word", "form").agg(F.sum("n").alias("c")))


@dataclass
class Vocabulary:
    """What tasks know of words: the listed ones in order, and the weight of each form."""

    words: list[bytes]
    counts: np.ndarray
    form_mass: np.ndarray  # sum of (count + 1) over the words beyond the list, and 1
    total: int
    distinct: int
    known: dict = field(default_factory=dict)

    def __post_init__(self):
        self.head = len(self.words)
        weight = self.counts + 1.0
        at = np.minimum((np.cumsum(weight) - weight) / weight.sum() * HEAD_CLASSES,
                        HEAD_CLASSES - 1).astype(np.int64)
        kinds, self.head_class = np.unique(at, return_inverse=True)
        self.head_classes = len(kinds)
        ends = np.searchsorted(self.head_class, np.arange(self.head_classes), side="right")
        classes = self.head_classes + FORMS
        self.layout = Layout(self.head + classes, self.head, classes, ends)

    def initial(self) -> np.ndarray:
        mass = np.concatenate([np.bincount(self.head_class, self.counts + 1.0), self.form_mass])
        return start(self.layout, mass / mass.sum(), self.counts + 1.0)

    def _prepare(self) -> None:
        """Tables over the listed words, built once in a task."""
        self.known = {w: i for i, w in enumerate(self.words)}
        self.weight = np.log10(self.counts + 1)

    def lookup(self, found: list[bytes]) -> list[np.ndarray]:
        """Of each word: input, class, head row or -1, log10 of count + 1 or -1 if it isn't listed,
        and log10 of its share in its class, without the count where that isn't known."""
        if not self.known:
            self._prepare()
        at = np.fromiter(map(lambda w: self.known.get(w, -1), found), np.int64, len(found))
        other = np.flatnonzero(at < 0)
        kinds = forms(pa.array([found[i] for i in other.tolist()], pa.large_binary()))
        kind, weight, share = self.head_class[at], self.weight[at], np.zeros(len(found))
        kind[other], weight[other] = self.head_classes + kinds, -1.0
        share[other] = -np.log10(self.form_mass)[kinds]
        inputs = np.where(at >= 0, at, self.head + kind)
        return [*(x.astype(np.int32) for x in (inputs, kind, at)), weight, share]


@dataclass
class Block:
    """A block's tokens for the network, with what is known of each token's count."""

    tokens: Tokens
    weight: np.ndarray
    share: np.ndarray
    codes: np.ndarray
    vocabulary: pa.Array


def tokenised(data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> Block:
    found = words(data, offsets, lower=True)
    end = len(found.vocabulary)
    table = vocabulary.lookup([*found.vocabulary.to_pylist(), END])
    rows = len(offsets) - 1
    first = found.first + np.arange(rows + 1)
    codes = np.full(first[-1], end, np.int64)
    inner = np.ones(len(codes), bool)
    inner[first[1:] - 1] = False
    codes[inner] = found.codes
    inputs, classes, rows_of_words, weight, share = (column[codes] for column in table)
    return Block(Tokens(inputs, classes, rows_of_words, first), weight, share, codes,
                 found.vocabulary)


def build_vocabulary(table: DataFrame) -> Vocabulary:
    """The listed words by falling count; the end token is always the first."""
    sums = table.agg(F.sum("c"), F.count("*")).first()
    top = table.where("word <> ''").orderBy(F.desc("c"), "word").limit(LISTED).select("word", "c")
    listed = top.toPandas()
    ends = table.where("word = ''").agg(F.sum("c")).first()[0] or 0
    names = [END, *(w.encode() for w in listed["word"])]
    numbers = np.array([ends, *listed["c"]], np.float64)
    mass = np.ones(FORMS)
    for row in table.where("word <> ''").groupBy("form").agg(
            F.sum(F.col("c") + 1).alias("m")).collect():  # at most FORMS rows
        mass[row.form] += row.m
    np.subtract.at(mass, forms(pa.array(names[1:], pa.large_binary())), numbers[1:] + 1)
    return Vocabulary(names, numbers, mass, int(sums[0] or 0), int(sums[1]))


def _joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes at least, out of smaller ones."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            whole, held, n = pa.Table.from_batches(held).combine_chunks(), [], 0
            yield from whole.to_batches()
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _trained(batches, vocabulary: Vocabulary, flat: np.ndarray, rate: float):
    trainer = Trainer(vocabulary.layout, flat, rate)
    for _, data, offsets in blocks(_joined(batches, LEARN_BLOCK), "text", LEARN_BLOCK):
        tokens = tokenised(data, offsets, vocabulary).tokens
        release_memory()  # what cutting the words took
        trainer.learn(tokens)
    if trainer.seen:
        yield from _pieces(trainer.seen, trainer.network.flat, flat)


KIND = "piece int, seen bigint, change binary"


def packed(numbers: np.ndarray) -> bytes:
    """The numbers without loss: first bytes, second bytes and so on, of which the last, with the
    exponents, are much alike."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    size = 4 * int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(bytes(data[8:]), size, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.float32).ravel()


def _pieces(seen: int, flat: np.ndarray, before: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k, at in enumerate(range(0, len(flat), PIECE)):
        yield pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([seen], pa.int64()),
             pa.array([packed(flat[at:at + PIECE] - before[at:at + PIECE])], pa.binary())], ["piece", "seen", "change"])


def _averaged(batches):
    """The mean of each piece, weighted by tokens."""
    found: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for k, n, weights in zip(*batch.columns):
            part = unpacked(weights.as_py())
            seen, mean = found.get(k.as_py(), (0, np.zeros(len(part))))
            seen += n.as_py()
            found[k.as_py()] = seen, mean + (part - mean) * (n.as_py() / seen)
    for k, (seen, mean) in sorted(found.items()):
        yield pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([seen], pa.int64()),
             pa.array([packed(mean.astype(np.float32))], pa.binary())], ["piece", "seen", "change"])


def train(training: DataFrame, vocabulary: Vocabulary, known: Broadcast) -> np.ndarray:
    """Weights after PASSES passes, each over the documents whose text's hash names it."""
    flat = vocabulary.initial()
    spark = training.sparkSession
    slots = spark.sparkContext.defaultParallelism
    tasks = max(1, min(slots, math.ceil(vocabulary.total / PASSES / TASK_TOKENS)))
    # Rows are pieces of a megabyte, so few go into an Arrow batch.
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "64"}):
        for turn in range(PASSES):
            part = training.where(F.pmod(F.xxhash64("text"), F.lit(PASSES)) == turn).select("text")
            sent = spark.sparkContext.broadcast(flat)
            found = part.coalesce(tasks).mapInArrow(
                lambda batches, sent=sent, rate=RATE / (1 + turn): _trained(
                    batches, known.value, sent.value, rate), KIND)
            if tasks > REDUCERS:  # first REDUCERS partial averages of everything
                found = found.repartition(REDUCERS).mapInArrow(_averaged, KIND)
            # One part at a time comes to the driver, and is added to the weights before it.
            for row in found.repartition("piece").mapInArrow(_averaged, KIND).toLocalIterator():
                mean = unpacked(row.change)
                flat[row.piece * PIECE:][:len(mean)] += mean
            sent.destroy()
            release_memory()
    return flat


PART = pa.struct([("word", pa.string()), ("n", pa.int64())])


def _scored(batches, vocabulary: Vocabulary, flat: np.ndarray):
    network = Network(vocabulary.layout, flat)
    for rows, data, offsets in blocks(batches, "text", BLOCK):
        block = tokenised(data, offsets, vocabulary)
        first, row = block.tokens.first, np.repeat(np.arange(len(rows)), np.diff(block.tokens.first))

        def sums(values: np.ndarray) -> np.ndarray:
            return np.bincount(row, values, len(rows))
        listed = block.weight >= 0
        score = log_likelihood(network, block.tokens) / math.log(10) + sums(block.share)
        pairs, n = np.unique(row[~listed] * (len(block.vocabulary) + 1) + block.codes[~listed],
                             return_counts=True)
        owner, code = np.divmod(pairs, len(block.vocabulary) + 1)
        places = np.searchsorted(owner, np.arange(len(rows) + 1)).astype(np.int32)
        others = pa.StructArray.from_arrays(
            [block.vocabulary.take(pa.array(code)).cast(pa.binary()).cast(pa.string()),
             pa.array(n.astype(np.int64))], ["word", "n"])
        known = (block.weight > 0).astype(float)
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(np.diff(first).astype(np.int64)),
             pa.array(sums(known).astype(np.int64)),
             pa.array(sums(np.where(listed, block.weight, 0.0))), pa.array(score),
             pa.ListArray.from_arrays(pa.array(places), others)],
            ["id", "n_tokens", "n_known", "weight", "score", "others"])


def language_scores(docs: DataFrame, modulus: int = 7, value: int = 2, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score): one row for each row."""
    rows = docs.select(F.col(f"`{key}`").alias("id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    apart: Column = held_out(F.col("id"), modulus, value)
    training = rows.where(~apart)
    table = stored(counts(training), "token-counts")
    vocabulary = build_vocabulary(table)
    context = docs.sparkSession.sparkContext
    known = context.broadcast(vocabulary)
    sent = context.broadcast(train(training, vocabulary, known))
    kind = dict(docs.dtypes)[key]
    first = stored(rows.mapInArrow(
        lambda batches: _scored(batches, known.value, sent.value),
        f"id {kind}, n_tokens bigint, n_known bigint, weight double, score double, "
        "others array<struct<word: string, n: bigint>>"), "language-scores")
    known.destroy()
    sent.destroy()
    # Words that tasks have no count of: looked up by a join, and added up for each row again.
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
    placed = first.withColumn("place", F.shiftleft(part, 40) + F.col("_metadata.row_index"))
    looked = (placed.select("place", F.inline("others"))
              .join(table.select("word", "c"), "word")
              .groupBy("place").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"),
                                    F.sum("n").alias("more_known")))
    more, more_known = F.coalesce("more", F.lit(0.0)), F.coalesce("more_known", F.lit(0))
    spread = math.log10(vocabulary.total + vocabulary.distinct + 1)
    return placed.drop("others").join(looked, "place", "left").select(
        "id", apart.alias("held_out"), "n_tokens", (F.col("n_known") + more_known).alias("n_known"),
        F.lit(vocabulary.total).cast("bigint").alias("train_tokens"),
        (F.col("weight") + more - F.col("n_tokens") * spread).alias("base_score"),
        (F.col("score") + more).alias("score"))
