"""Language model: counts and base scores against plain counting, probabilities, gradients, gain."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tripledger.llm import gru
from tripledger.llm.gru import Layout, Network, Tokens, Trainer, log_likelihood, start, windows
from tripledger.llm.language_model import (
    Vocabulary,
    _joined,
    form,
    language_scores,
    packed,
    tokenised,
    train,
    unpacked,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def corpus(n=500, seed=6):
    draw = random.Random(seed)
    kinds = [[f"{c}{i}" for i in range(60)] for c in "abc"]
    rows = [(i, " ".join(draw.choice(kinds[i % 3]) for _ in range(draw.randrange(1, 60))))
            for i in range(n)]
    rows += [(None, "a1 b2"), (n, None), (n + 1, ""), (n + 2, "é unseen. Words"), (n + 3, "a1 " * 20_000)]
    return rows + [rows[0]]


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS id", "2 AS c", "3 AS place").repartition(3)
    return rows, language_scores(docs).collect(), docs


def test_counts_and_base_scores(scored):
    rows, got, _ = scored
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    count = Counter(t for i, text in rows if not held[i] for t in tokens_of(text))
    total, distinct = sum(count.values()), len(count)
    want = sorted((str(i), held[i], len(t := tokens_of(text)), sum(count[x] > 0 for x in t), total,
                   round(sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in t), 4))
                  for i, text in rows)
    assert sorted((str(r.id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 4)) for r in got) == want


def test_the_model_beats_the_base_on_held_out_rows(scored):
    _, got, _ = scored
    held = [r for r in got if r.held_out and r.n_tokens > 10]
    assert len(held) > 30 and all(r.score < 0 for r in got)
    assert sum(r.score - r.base_score for r in held) > 0.1 * sum(r.n_tokens for r in held)


def test_empty_table(scored):
    assert language_scores(scored[2].limit(0)).count() == 0


def small():
    names = [b"", *(f"w{i}".encode() for i in range(40))]
    mass = np.ones(68)
    mass[form(b"q")] += 12
    return Vocabulary(names, np.arange(41, 0, -1).astype(float), mass, 1000, 50)


def test_probabilities_of_all_outcomes_add_up_to_one():
    vocabulary = small()
    flat = vocabulary.initial()
    flat += np.random.default_rng(1).normal(0, 0.2, len(flat)).astype(np.float32)
    network = Network(vocabulary.layout, flat)
    states = np.ones((5, gru.HIDDEN + 1), np.float32)
    states[:, :-1] = np.random.default_rng(2).normal(0, 1, (5, gru.HIDDEN))
    total = np.zeros(5)
    for word in vocabulary.words:
        _, kind, row, _, _ = (column[0] for column in vocabulary.lookup([word]))
        total += np.exp(network.output(states, np.full(5, kind), np.full(5, row))[0])
    for k in range(68):
        total += np.exp(network.output(states, np.full(5, vocabulary.head_classes + k),
                                       np.full(5, -1))[0])
    assert np.allclose(total, 1, atol=1e-4)


def test_windows_carry_the_state_over_whole_documents(monkeypatch):
    vocabulary = small()
    flat = vocabulary.initial() + np.float32(0.05)
    network = Network(vocabulary.layout, flat)
    raw = [b"w1 w2 w3 zz " * 50, b"", b"w5 w6", b"w9 " * 333]
    data = np.frombuffer(b"".join(raw), np.uint8)
    block = tokenised(data, np.cumsum([0, *map(len, raw)]), vocabulary)
    whole = log_likelihood(network, block.tokens)
    monkeypatch.setattr(gru, "SCORE_WINDOW", 7)
    monkeypatch.setattr(gru, "SCORE_LANES", 2)
    assert np.allclose(log_likelihood(network, block.tokens), whole, rtol=1e-4)
    seen = np.concatenate([g[g >= 0] for g, _, _ in windows(block.tokens, 2, 7)])
    assert sorted(seen.tolist()) == list(range(len(block.codes)))


def test_gradient_equals_differences():
    layout = Layout(6, 5, 4, np.array([2, 5]))
    flat = start(layout, np.full(4, 0.25), np.ones(5)).astype(np.float64)
    flat += np.random.default_rng(0).normal(0, 0.3, len(flat))
    inputs = np.array([[0, 1], [2, 3], [4, 5], [1, 2]])
    classes, words = np.array([0, 1, 2, 3, 1, 0, 1, 1]), np.array([0, 2, -1, -1, 4, 1, 3, 2])
    begins = np.zeros((4, 2), bool)
    begins[0] = begins[2, 1] = True

    def loss(p):
        network = Network(layout, p.astype(np.float32))
        before, _, _ = network.run(inputs, begins, np.zeros((2, gru.HIDDEN), np.float32), False)
        return -network.output(before.reshape(8, -1), classes, words)[0].astype(float).sum()
    network = Network(layout, flat.astype(np.float32))
    before, _, kept = network.run(inputs, begins, np.zeros((2, gru.HIDDEN), np.float32), True)
    gradient = np.zeros(len(flat), np.float32)
    parts = layout.split(gradient)
    back = network.output(before.reshape(8, -1), classes, words, parts, 1.0)[1]
    network.backward(inputs, begins, before, kept, back.reshape(4, 2, -1), parts)
    for i in np.random.default_rng(3).choice(len(flat), 60, replace=False):
        step = np.zeros(len(flat))
        step[i] = 1e-2
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-2 - gradient[i]) < 2e-2


def test_training_lowers_the_loss():
    vocabulary = small()
    raw = [b"w1 w2 w3 " * 30, b"w7 w8 w9 " * 30] * 40
    data = np.frombuffer(b"".join(raw), np.uint8)
    tokens: Tokens = tokenised(data, np.cumsum([0, *map(len, raw)]), vocabulary).tokens
    trainer = Trainer(vocabulary.layout, vocabulary.initial())
    before = log_likelihood(trainer.network, tokens).sum()
    for _ in range(60):
        trainer.learn(tokens)
    assert log_likelihood(trainer.network, tokens).sum() > 0.8 * before


def test_every_training_token_is_learned_from():
    vocabulary = small()
    raw = [b"w1 w2 w3 " * 40, b"w30 " * 20]  # one lane could hide the short one between two losses
    data = np.frombuffer(b"".join(raw), np.uint8)
    tokens = tokenised(data, np.cumsum([0, *map(len, raw)]), vocabulary).tokens
    trainer = Trainer(vocabulary.layout, vocabulary.initial())
    row = vocabulary.lookup([b"w30"])[0][0]
    before = trainer.network.by_input[row].copy()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(gru, "TRAIN_LANES", 1)
        trainer.learn(tokens)
    assert trainer.seen == len(tokens.inputs)
    assert not np.allclose(trainer.network.by_input[row], before)


def test_context_tells_listed_words_beyond_the_most_frequent_apart():
    names = [b"", *(f"w{i}".encode() for i in range(4000))]
    vocabulary = Vocabulary(names, np.arange(4001, 0, -1).astype(float), np.ones(68), 9000, 4001)
    inputs, _, rows, _, _ = vocabulary.lookup([b"w3990", b"w3991", b"unseen"])
    assert inputs[0] != inputs[1] and rows[0] != rows[1] and min(rows[:2]) >= 0 and rows[2] == -1
    raw = [b"w3990 w3992 " * 30, b"w3991 w3993 " * 30] * 20
    data = np.frombuffer(b"".join(raw), np.uint8)
    tokens = tokenised(data, np.cumsum([0, *map(len, raw)]), vocabulary).tokens
    trainer = Trainer(vocabulary.layout, vocabulary.initial())
    for _ in range(12):
        trainer.learn(tokens)
    raw = [b"w3990 w3992", b"w3990 w3993"]
    data = np.frombuffer(b"".join(raw), np.uint8)
    right, wrong = log_likelihood(trainer.network, tokenised(
        data, np.cumsum([0, *map(len, raw)]), vocabulary).tokens)
    assert right > wrong + 1


def test_a_step_leaves_classes_alone_that_its_window_lacks():
    names = [b"", *(f"w{i}".encode() for i in range(4000))]
    vocabulary = Vocabulary(names, np.arange(4001, 0, -1).astype(float), np.ones(68), 9000, 4001)
    trainer = Trainer(vocabulary.layout, vocabulary.initial())

    def learned(raw):
        data = np.frombuffer(raw, np.uint8)
        trainer.learn(tokenised(data, np.array([0, len(raw)]), vocabulary).tokens)
        return trainer.network.by_word.copy()
    _, kinds, rows, _, _ = vocabulary.lookup([b"w3990", b"w20"])
    assert kinds[0] != kinds[1]
    start, first, second = vocabulary.layout.split(vocabulary.initial())[3], *(
        learned(raw) for raw in (b"w3990 w3991 " * 30, b"w20 w21 " * 30))
    assert not np.allclose(first[rows[0]], start[rows[0]])
    assert np.array_equal(first[rows[0]], second[rows[0]])
    assert not np.allclose(first[rows[1]], second[rows[1]])
    assert not trainer.gradient.any()


def listed(n):
    names = [b"", *(f"w{i}".encode() for i in range(n))]
    return Vocabulary(names, np.arange(n + 1, 0, -1).astype(float), np.ones(68), 9000, n + 1)


def test_weights_come_to_the_driver_in_parts(spark, monkeypatch):
    vocabulary = listed(8000)
    size = vocabulary.layout.size()
    vocabulary.initial()
    tracemalloc.start()
    vocabulary.initial()
    assert tracemalloc.get_traced_memory()[1] < 1.6 * 4 * size
    tracemalloc.stop()
    docs = spark.createDataFrame([(f"w{i % 7} w{i} w{i + 1}",) for i in range(400)], "text string")
    known = spark.sparkContext.broadcast(vocabulary)

    def collected(_):
        raise AssertionError("all weights at once")
    monkeypatch.setattr(type(docs), "collect", collected)
    flat = train(docs, vocabulary, known)
    assert len(flat) == size and np.isfinite(flat).all()
    first, second = (vocabulary.layout.split(w)[0] for w in (vocabulary.initial(), flat))
    rows = vocabulary.lookup([b"w3", b"w399", b"w7000"])[0]
    changed = [not np.allclose(first[r], second[r]) for r in rows]
    assert changed == [True, True, False]


def test_small_batches_share_the_lanes():
    batches = [pa.RecordBatch.from_pydict({"text": [f"w{i} w{i + 1}", None]}) for i in range(50)]
    whole = [b["text"].to_pylist() for b in _joined(iter(batches), 1 << 20)]
    assert whole == [[x for b in batches for x in b["text"].to_pylist()]]
    parts = [b["text"].to_pylist() for b in _joined(iter(batches), 100)]
    assert len(parts) > 1 and sum(parts, []) == whole[0]


def test_choices_lead_to_each_word_and_start_at_its_frequency():
    vocabulary = listed(4000)
    network = Network(vocabulary.layout, vocabulary.initial())
    ways = network.ways
    assert ways.shape[1] <= 16 and (ways[-1] == -1).all()
    states = np.random.default_rng(5).normal(0, 1, (4001, gru.HIDDEN + 1)).astype(np.float32)
    states[:, -1] = 1
    _, kinds, rows, _, _ = vocabulary.lookup(vocabulary.words)
    got = np.exp(network.output(states, kinds, rows)[0])
    mass = vocabulary.counts + 1
    assert np.allclose(got, mass / (mass.sum() + vocabulary.form_mass.sum()), rtol=1e-3)


def test_changes_are_packed_without_loss():
    numbers = np.random.default_rng(4).normal(0, 0.01, 100_000).astype(np.float32)
    numbers[::3] = 0
    assert np.array_equal(unpacked(packed(numbers)), numbers)
    assert len(packed(numbers)) < 0.95 * numbers.nbytes
