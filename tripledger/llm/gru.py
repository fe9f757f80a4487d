"""A gated recurrent network with a class-factored output softmax, in numpy, over many lanes.

Documents are laid end to end in lanes that run side by side; a lane's state is cleared where a
document begins and carried from window to window otherwise, so a document's likelihood is over its
whole text. Training is truncated back-propagation: the loss is taken at every token of every window,
and gradients stop at a window's first token.

Outcomes are factored: a class, by a softmax, then a member. Head words (all listed ones) are in
classes of similar weight; a member is reached by choices between two halves of what is left of its
class, each with weights of its own over the state, so each word has a learned probability. All other
words are in classes by their form, with fixed shares inside their class. Rows of inputs and choices
that a window lacks are left alone by its step: their gradients are zero.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

HIDDEN = 24
TRAIN_LANES, TRAIN_WINDOW = 256, 16
SCORE_LANES, SCORE_WINDOW = 512, 32
LEAST_LANES, LEAST_STEPS = 4, 64
RATE = 0.01
FLOOR = 1e-5  # below it a gradient counts as noise: rare words would drift at full rate
CHUNK = 2048
SHORT = 8  # stretches of up to so many rows are added up side by side


@dataclass
class Layout:
    """Sizes of a network. ``ends[k]`` is where the head words of class k end."""

    inputs: int
    head: int
    classes: int
    ends: np.ndarray

    def shapes(self) -> list[tuple[int, ...]]:
        h = HIDDEN
        return [(self.inputs, 3 * h), (h, 3 * h), (self.classes, h + 1), (self.head, h + 1)]

    def split(self, flat: np.ndarray) -> list[np.ndarray]:
        """Views of the parameters: input, recurrent, classes and words, with biases last."""
        out, at = [], 0
        for shape in self.shapes():
            size = int(np.prod(shape))
            out.append(flat[at:at + size].reshape(shape))
            at += size
        return out

    def ways(self) -> np.ndarray:
        """Choices that lead to each head word from its class, -1 after the last and in a last row of
        its own for other words. Choice i halves a stretch of members, after word i."""
        ends = np.asarray(self.ends)
        sizes = np.diff(ends, prepend=0)
        low, high = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
        word, out = np.arange(self.head), []
        while (open_ := high - low > 1).any():
            middle = (low + high) // 2
            out.append(np.where(open_, middle - 1, -1))
            left = word < middle
            low, high = np.where(left | ~open_, low, middle), np.where(left & open_, middle, high)
        table = np.full((self.head + 1, len(out)), -1, np.int32)
        for level, choice in enumerate(out):
            table[:-1, level] = choice
        return table

    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.shapes())


def start(layout: Layout, class_mass: np.ndarray, head_mass: np.ndarray, seed: int = 9) -> np.ndarray:
    """Parameters under which every token has its frequency as its probability."""
    draw = np.random.default_rng(seed)
    flat = draw.standard_normal(layout.size(), np.float32)
    flat *= np.float32(0.1)
    _, recurrent, by_class, by_word = layout.split(flat)
    recurrent *= 2
    by_class[:] = 0
    by_word[:] = 0
    by_class[:, -1] = np.log(np.maximum(class_mass, 1e-9))
    mass = np.concatenate([[0], np.cumsum(np.maximum(head_mass, 1e-9))])
    ends = np.asarray(layout.ends)
    sizes = np.diff(ends, prepend=0)
    low, high = ends - sizes, ends
    while (wide := high - low > 1).any():
        low, high = low[wide], high[wide]
        middle = (low + high) // 2
        by_word[middle - 1, -1] = np.log((mass[middle] - mass[low]) / (mass[high] - mass[middle]))
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
    return flat


@dataclass
class Tokens:
    """Documents' tokens end to end: what goes into the network and what comes out."""

    inputs: np.ndarray
    classes: np.ndarray
    words: np.ndarray  # row of the head word, -1 outside the head
    first: np.ndarray  # where each document begins, and the end


def lanes(first: np.ndarray, most: int) -> list[list[int]]:
    """Documents dealt to at most ``most`` lanes of about equal length, the longest lane first."""
    sizes = np.diff(first)
    full = np.flatnonzero(sizes)
    order = full[np.argsort(-sizes[full], kind="stable")]
    heap = [(0, k) for k in range(min(most, len(order)))]
    dealt: list[list[int]] = [[] for _ in heap]
    for doc in order.tolist():
        length, k = heapq.heappop(heap)
        dealt[k].append(doc)
        heapq.heappush(heap, (length + int(sizes[doc]), k))
    return [dealt[k] for _, k in sorted(heap, key=lambda x: -x[0])]


def windows(tokens: Tokens, most: int, width: int):
    """Token numbers as (steps, lanes) for each window, -1 after a lane's end, with the places where
    a document begins, and the number of lanes still running."""
    dealt = lanes(tokens.first, most)
    if not dealt:
        return
    runs = np.concatenate([np.arange(tokens.first[d], tokens.first[d + 1])
                           for docs in dealt for d in docs])
    begins = np.zeros(tokens.first[-1] + 1, bool)
    begins[tokens.first[:-1]] = True
    sizes = np.diff(tokens.first)
    lengths = np.array([int(sizes[docs].sum()) for docs in dealt])
    starts = np.cumsum(lengths) - lengths
    for at in range(0, int(lengths[0]), width):
        running = int((lengths > at).sum())
        step = np.arange(at, min(at + width, int(lengths[0])))[:, None]
        live = step < lengths[:running]
        grid = np.where(live, runs.take(starts[:running] + step, mode="clip"), -1)
        yield grid, begins[grid] & live, running


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def summed(parts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the stretches of rows that begin at ``first``.

    `reduceat` takes a turn for each stretch and column, which is slow where most stretches are short:
    these are added up side by side, one row of each at a time."""
    lengths = np.diff(first, append=len(parts))
    total = parts.take(first, 0)
    short = np.flatnonzero((lengths > 1) & (lengths <= SHORT))
    for k in range(1, SHORT):
        short = short[lengths[short] > k]
        if not len(short):
            break
        put_rows(total, short, total.take(short, 0) + parts.take(first[short] + k, 0))
    long = lengths > SHORT
    if long.any():
        sizes = lengths[long]
        total[long] = np.add.reduceat(parts[np.repeat(long, lengths)], np.cumsum(sizes) - sizes, axis=0)
    return total


def put_rows(table: np.ndarray, where: np.ndarray, rows: np.ndarray) -> None:
    """``table[where] = rows`` for whole rows, each copied as one item."""
    item = f"V{table.shape[1] * table.itemsize}"
    table.view(item).ravel().put(where, np.ascontiguousarray(rows).view(item).ravel())


def by_row(rows: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that occur, once each, and the sums of the ``parts`` that are for them."""
    order = np.argsort(rows)
    ordered = rows[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    return ordered[first], summed(parts.take(order, 0), first)


class Network:
    def __init__(self, layout: Layout, flat: np.ndarray):
        self.layout, self.flat = layout, flat
        self.ways = layout.ways()
        self.by_input, self.recurrent, self.by_class, self.by_word = layout.split(flat)
        self._logits = np.empty((CHUNK, layout.classes), np.float32)  # fresh pages cost as much as a product
        self._ones = np.ones(layout.classes, np.float32)

    def run(self, inputs: np.ndarray, begins: np.ndarray, state: np.ndarray, keep: bool):
        """States before each token (with a one at the end), the last state, and what
        back-propagation needs."""
        steps, n = inputs.shape
        h = HIDDEN
        before = np.ones((steps, n, h + 1), np.float32)
        kept = np.empty((4, steps, n, h), np.float32) if keep else None
        fed = self.by_input.take(inputs, 0)
        for t in range(steps):
            if begins[t].any():
                state = np.where(begins[t][:, None], np.float32(0), state)
            before[t, :, :h] = state
            carried = state @ self.recurrent
            gates = _sigmoid(fed[t, :, :2 * h] + carried[:, :2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            inner = carried[:, 2 * h:]
            fresh = _sigmoid(2 * (fed[t, :, 2 * h:] + reset * inner))
            fresh *= 2
            fresh -= 1
            if keep:
                kept[0, t], kept[1, t], kept[2, t], kept[3, t] = update, reset, inner, fresh
            state = fresh + update * (state - fresh)
        return before, state, kept

    def output(self, before: np.ndarray, classes: np.ndarray, words: np.ndarray,
               gradient: list[np.ndarray] | None = None, scale: float = 1.0):
        """Natural log probability of each token given the states; with ``gradient`` also the
        gradient of minus ``scale`` times their sum, which is returned for the states."""
        out, back, met = self.learned(before, classes, words, None if gradient is None else gradient[2], scale)
        if gradient is not None:
            gradient[3][met[0]] += met[1]
        return out, back

    def learned(self, before: np.ndarray, classes: np.ndarray, words: np.ndarray,
                by_class: np.ndarray | None, scale: float):
        """The same, with the gradient of the classes added to ``by_class``, and that of the choices
        returned as the rows of those met, once each."""
        n = len(classes)
        out = np.empty(n, np.float32)
        back = None if by_class is None else np.empty((n, HIDDEN), np.float32)
        for at in range(0, n, CHUNK):
            part = slice(at, min(at + CHUNK, n))
            out[part], found = self._softmax(before[part], classes[part], by_class, scale)
            if back is not None:
                back[part] = found
        among, met = self._choices(before, words, back, scale)
        out += among
        return out, back, met

    def _softmax(self, states, own, gradient, scale: float):
        """Log probability of each state's own class, and the states' gradients."""
        logits = np.matmul(states, self.by_class.T, out=self._logits[:len(own)])
        index = (np.arange(len(own)), own)
        value = logits[index]
        np.exp(logits, out=logits)
        total = logits @ self._ones
        value -= np.log(total)
        if gradient is None:
            return value, None
        # All that follows is in proportion to the totals, so the few states are scaled, not the many logits.
        logits[index] -= total
        share = (np.float32(scale) / total)[:, None]
        gradient += logits.T @ (states * share)
        back = logits @ self.by_class[:, :HIDDEN]
        back *= share
        return value, back

    def _choices(self, states, words, back, scale: float):
        """Log probability of the choices that lead to each state's word within its class. With
        ``back``, the states' gradients are added to it, and those of the choices are returned.

        States are taken by word: at each level equal choices are then neighbours, so that neither
        their weights nor their gradients have to be sorted."""
        order = np.argsort(words)
        order = order[np.searchsorted(words, 0, sorter=order):]
        own = words.take(order)
        ways = self.ways.take(own, 0).T
        level, at = np.nonzero(ways >= 0)
        nodes, owner = ways[level, at], order.take(at)
        met, weights = states.take(owner, 0), self.by_word.take(nodes, 0)
        margin = np.einsum("ij,ij->i", met, weights)
        left = own.take(at) <= nodes
        np.negative(margin, out=margin, where=~left)
        small = np.exp(-np.abs(margin))
        value = np.bincount(owner, np.minimum(margin, 0) - np.log1p(small), len(words))
        value = value.astype(np.float32)
        if back is None:
            return value, None
        wrong = np.where(margin < 0, np.float32(scale), np.float32(scale) * small) / (1 + small)
        np.negative(wrong, out=wrong, where=left)
        weights *= wrong[:, None]
        met *= wrong[:, None]
        ends = np.searchsorted(level, np.arange(len(ways) + 1))
        for part in map(slice, ends, ends[1:]):  # a state has one choice a level
            put_rows(back, owner[part], back.take(owner[part], 0) + weights[part, :HIDDEN])
        first = np.flatnonzero(np.diff(nodes, prepend=-1))
        return value, (nodes[first], summed(met, first))

    def backward(self, inputs, begins, before, kept, d_before, gradient):
        """Carry the states' gradients back through the window's steps: the rows of its inputs, once
        each, and their gradients, which are added to ``gradient`` too if it has a place for them."""
        h = HIDDEN
        before, (update, reset, inner, fresh) = before[:, :, :h], kept
        d_state = np.zeros_like(before[0])
        # What a state's gradient is multiplied by, for each of the gates: update, reset, fresh.
        by = np.empty((*inputs.shape, 3, h), np.float32)
        rest = 1 - update
        by[:, :, 2] = rest * (1 - fresh * fresh)
        by[:, :, 0] = (before - fresh) * update * rest
        by[:, :, 1] = by[:, :, 2] * inner * reset * (1 - reset)
        d_fed = np.empty((*inputs.shape, 3 * h), np.float32)
        carried = np.empty_like(d_fed)
        back = np.ascontiguousarray(self.recurrent.T)
        for t in range(len(inputs) - 1, -1, -1):
            np.multiply(d_state[:, None], by[t], out=d_fed[t].reshape(-1, 3, h))
            carried[t, :, :2 * h] = d_fed[t, :, :2 * h]
            np.multiply(d_fed[t, :, 2 * h:], reset[t], out=carried[t, :, 2 * h:])
            d_state *= update[t]
            d_state += carried[t] @ back
            d_state += d_before[t]
            if begins[t].any():
                d_state[begins[t]] = 0
        gradient[1] += before.reshape(-1, h).T @ carried.reshape(-1, 3 * h)
        rows, sums = by_row(inputs.ravel(), d_fed.reshape(-1, 3 * h))
        if gradient[0] is not None:
            gradient[0][rows] += sums
        return rows, sums


def log_likelihood(network: Network, tokens: Tokens) -> np.ndarray:
    """Sum over each document of the natural log probabilities that the network gives."""
    each = np.zeros(len(tokens.inputs))
    state = np.zeros((0, HIDDEN), np.float32)
    for grid, begins, running in windows(tokens, SCORE_LANES, SCORE_WINDOW):
        state = state[:running] if len(state) else np.zeros((running, HIDDEN), np.float32)
        before, state, _ = network.run(tokens.inputs[grid], begins, state, False)
        real = grid >= 0
        number = grid[real]
        each[number] = network.output(before[real], tokens.classes[number],
                                      tokens.words[number])[0]
    total = np.concatenate([[0.0], np.cumsum(each)])
    return total[tokens.first[1:]] - total[tokens.first[:-1]]


class Trainer:
    """Adam over windows of truncated back-propagation."""

    def __init__(self, layout: Layout, flat: np.ndarray, rate: float = RATE):
        self.network, self.rate = Network(layout, flat.copy()), rate
        # Not zeros_like, which would write to all of it: rows that are never met take no memory.
        self.moments = [np.zeros(len(flat), flat.dtype) for _ in range(2)]
        # Only what each window changes as a whole: inputs and choices have their gradients by row.
        recurrent, by_class = layout.shapes()[1:3]
        self.gradient = np.zeros(int(np.prod(recurrent)) + int(np.prod(by_class)), flat.dtype)
        self.whole = [self.gradient[:np.prod(recurrent)].reshape(recurrent),
                      self.gradient[np.prod(recurrent):].reshape(by_class)]
        self.steps = self.seen = 0

    def learn(self, tokens: Tokens) -> None:
        network = self.network
        state = np.zeros((0, HIDDEN), np.float32)
        # Few tokens run in fewer lanes, so that they make enough steps too.
        most = min(TRAIN_LANES, max(LEAST_LANES, len(tokens.inputs) // (TRAIN_WINDOW * LEAST_STEPS)))
        for grid, begins, running in windows(tokens, most, TRAIN_WINDOW):
            state = state[:running] if len(state) else np.zeros((running, HIDDEN), np.float32)
            inputs = tokens.inputs[grid]
            before, state, kept = network.run(inputs, begins, state, True)
            real = grid >= 0
            number = grid[real]
            d_before = np.zeros((*grid.shape, HIDDEN), np.float32)
            _, d_before[real], choices = network.learned(
                before[real], tokens.classes[number], tokens.words[number], self.whole[1], 1 / len(number))
            fed = network.backward(inputs, begins, before, kept, d_before, [None, self.whole[0]])
            self._step(fed, choices, len(number) / (most * TRAIN_WINDOW))
            self.seen += len(number)

    def _step(self, fed: tuple, choices: tuple, share: float) -> None:
        """A step in proportion to the window's tokens: few lanes run in a long document's end. ``fed``
        and ``choices`` are the rows of inputs and of words' choices that the window has, and their
        gradients."""
        self.steps += 1
        split = self.network.layout.split
        gradients = [fed[1], *self.whole, choices[1]]
        norm = float(np.sqrt(sum(float(np.vdot(g, g)) for g in gradients)))
        rate = share * self.rate * np.sqrt(1 - 0.99 ** self.steps) / (1 - 0.9 ** self.steps)
        scale = np.float32(1 / max(norm, 1.0))
        for weights, gradient, first, second, where in zip(
                split(self.network.flat), gradients, *map(split, self.moments), (fed[0], None, None, choices[0])):
            if where is None:
                weights -= self._change(gradient, first, second, scale, np.float32(rate))
                continue
            of = [first.take(where, 0), second.take(where, 0)]
            change = self._change(gradient, *of, scale, np.float32(rate))
            put_rows(weights, where, weights.take(where, 0) - change)
            put_rows(first, where, of[0])
            put_rows(second, where, of[1])
        self.gradient[:] = 0

    @staticmethod
    def _change(gradient, first, second, scale, rate) -> np.ndarray:
        """What Adam takes off; the moments are brought up to date in place."""
        gradient *= scale
        first += np.float32(0.1) * (gradient - first)
        gradient *= gradient
        gradient -= second
        gradient *= np.float32(0.01)
        second += gradient
        out = np.sqrt(second)
        out += np.float32(FLOOR)
        np.divide(first, out, out=out)
        out *= rate
        return out
