"""Texts of an Arrow batch as flat byte arrays: blocks of bounded size, words, dictionary codes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 500_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def blocks(batches: Iterable[pa.RecordBatch], text: str,
           size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of about ``size`` bytes of text, each with its bytes and its rows' offsets.

    A longer text is a slice of its own. A null counts as empty. What the task took is given back to
    the machine at its end, as a worker process stays for later tasks.
    """
    try:
        for batch in batches:
            data, offsets = text_bytes(batch.column(text))
            at = 0
            while at < len(batch):
                end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
                end = min(max(end, at + 1), len(batch))
                yield (batch.slice(at, end - at), data[offsets[at]:offsets[end]],
                       offsets[at:end + 1] - offsets[at])
                at = end
    finally:
        release_memory()


def release_memory() -> None:
    """Give memory that is free in this process back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and where each row begins (and the end)."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset:column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words in text order: byte spans, dictionary codes, and the first word of each row."""

    begin: np.ndarray
    end: np.ndarray
    codes: np.ndarray
    vocabulary: pa.Array
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of true bytes; a run ends with its row."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = offsets[(offsets > 0) & (offsets < n)]
    opens, closes = inside.copy(), inside.copy()
    joined = inside[1:] & inside[:-1]
    opens[1:] &= ~joined
    closes[:-1] &= ~joined
    opens[inner] = inside[inner]
    closes[inner - 1] = inside[inner - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def pieces(data: np.ndarray, begin: np.ndarray, end: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The spans as a binary array. ``keep`` marks exactly the bytes inside the spans."""
    places = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(end - begin, out=places[1:])
    flat = np.ascontiguousarray(data[keep])
    return pa.Array.from_buffers(pa.large_binary(), len(begin),
                                 [None, pa.py_buffer(places), pa.py_buffer(flat)])


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Maximal runs of bytes other than space and x09-x0D; ``lower`` lower-cases A-Z."""
    inside = ~_SPACE[data]
    begin, end = runs(inside, offsets)
    coded = pieces(_LOWER[data] if lower else data, begin, end, inside).dictionary_encode()
    return Words(begin, end, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                 coded.dictionary, np.searchsorted(begin, offsets))


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte (one more entry than bytes)."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i + 1]]`` for each row i."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: well spread 64-bit numbers."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes, modulo 2**64, of every window of a sequence of 64-bit values."""

    BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        self.back = np.ones(n + 1, np.uint64)
        power = np.ones(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumprod(np.full(n, self.BASE, np.uint64), out=power[1:])
            inverse = pow(self.BASE, -1, 1 << 64)
            np.cumprod(np.full(n, inverse, np.uint64), out=self.back[1:])
            np.cumsum(values * power[:-1], out=self.sums[1:])

    def windows(self, size: int) -> np.ndarray:
        """The hash of the ``size`` values from each place where that many follow."""
        if size >= len(self.sums):
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            return mixed((self.sums[size:] - self.sums[:-size]) * self.back[:len(self.sums) - size])


def twice(keys: np.ndarray) -> np.ndarray:
    """Marks the entries whose value occurs more than once."""
    ordered = np.sort(keys)
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(again) == 0:
        return np.zeros(len(keys), bool)
    place = np.searchsorted(again, keys)
    place[place == len(again)] = 0
    return again[place] == keys
