"""Gradients and forms that are made for all rows or words at once equal those made one by one."""

import numpy as np
import pyarrow as pa
import pytest

from tripledger.llm import gru
from tripledger.llm.gru import Network, Trainer, by_row, put_rows, summed
from tripledger.llm.language_model import Vocabulary, forms


def listed(n):
    names = [b"", *(f"w{i}".encode() for i in range(n))]
    return Vocabulary(names, np.arange(n + 1, 0, -1).astype(float), np.ones(68), 9000, n + 1)


def one_form(word):
    accent = next((1 + word[i + 1] % 16 for i in range(len(word) - 1) if word[i] >= 0xC0), 0)
    kind = {46: 1, 44: 2}.get(word[-1], 0 if word[-1] >= 128 or chr(word[-1]).isalnum() else 3)
    return accent * 4 + kind


def test_forms_of_many_words():
    draw = np.random.default_rng(1)
    words = [bytes(draw.integers(1, 256, draw.integers(1, 6)).astype(np.uint8)) for _ in range(3000)]
    words += ["é".encode(), "naïvé,".encode(), b"\xc3", b"a\xc3", b".", b"end.", b"(x)", b"9"]
    found = pa.array(words, pa.large_binary())
    assert forms(found).tolist() == [one_form(w) for w in words]
    assert forms(found.slice(5, 90)).tolist() == [one_form(w) for w in words[5:95]]
    assert len(forms(found.slice(0, 0))) == 0


@pytest.mark.parametrize("n", [0, 1, 700])
def test_rows_are_added_up(n):
    draw = np.random.default_rng(n)
    rows = np.where(draw.random(n) < 0.5, 3, draw.integers(0, 300, n))  # one long stretch, many short ones
    parts = draw.normal(0, 1, (n, 5)).astype(np.float32)
    want = np.zeros((300, 5))
    np.add.at(want, rows, parts)
    own, sums = by_row(rows, parts)
    assert own.tolist() == sorted(set(rows.tolist()))
    assert np.allclose(sums, want[own], atol=1e-4)
    table = np.zeros((300, 5), np.float32)
    put_rows(table, own, sums)
    assert np.allclose(table, want, atol=1e-4)


def test_stretches_of_every_length():
    sizes = np.arange(1, 3 * gru.SHORT)
    parts = np.random.default_rng(2).normal(0, 1, (sizes.sum(), 3)).astype(np.float32)
    first = np.cumsum(sizes) - sizes
    assert np.allclose(summed(parts, first), [parts[a:a + n].sum(0) for a, n in zip(first, sizes)], atol=1e-4)


def test_choices_are_returned_once_each_with_their_gradients():
    vocabulary = listed(4000)
    draw = np.random.default_rng(3)
    flat = vocabulary.initial() + draw.normal(0, 0.1, vocabulary.layout.size()).astype(np.float32)
    network = Network(vocabulary.layout, flat)
    words = np.concatenate([draw.integers(-1, 4001, 5000), np.full(300, 3990)])
    classes = np.where(words < 0, vocabulary.head_classes, vocabulary.head_class[words])
    states = np.ones((len(words), gru.HIDDEN + 1), np.float32)
    states[:, :-1] = draw.normal(0, 1, (len(words), gru.HIDDEN))
    gradient = vocabulary.layout.split(np.zeros(len(flat), np.float32))
    out, back = network.output(states, classes, words, gradient, 0.5)
    by_class = np.zeros_like(gradient[2])
    again, back_again, (nodes, sums) = network.learned(states, classes, words, by_class, 0.5)
    assert len(set(nodes.tolist())) == len(nodes) == len(sums)
    assert sorted(nodes.tolist()) == np.unique(network.ways[words])[1:].tolist()
    assert np.array_equal(out, again) and np.array_equal(back, back_again)
    assert np.allclose(gradient[3][nodes], sums) and np.count_nonzero(gradient[3].any(1)) == len(nodes)
    parts = vocabulary.layout.split(np.zeros(len(flat), np.float32))
    for at in range(0, len(words), 100):
        few = slice(at, at + 100)
        value, own = network.output(states[few], classes[few], words[few], parts, 0.5)
        assert np.allclose(value, out[few], atol=1e-4) and np.allclose(own, back[few], atol=1e-4)
    assert all(np.allclose(p, g, atol=1e-2) for p, g in zip(parts[2:], gradient[2:]))


def test_a_trainer_has_no_place_for_every_gradient():
    vocabulary = listed(4000)
    assert Trainer(vocabulary.layout, vocabulary.initial()).gradient.size < vocabulary.layout.size() / 10
