"""Quality rules by repetition coverage: how much of a text lies in duplicated n-grams and lines.

Words are coded per block, every n-gram length gets rolling hashes over the codes, and each later
occurrence of a hash in a row's text marks the words it covers. The first occurrence is not counted
against a text, so one notice printed twice does not reject a short document. The work is one pass
in tasks without a shuffle.

Defined results: a null or empty text has no words, zero measures and fails the base rule; a row is
judged by its own text only, so repeated rows and ties get equal results; an empty table gives an
empty result; a text of any length is read whole; columns of the input never clash with measures,
because ``measure`` returns the key and the measures alone and ``keep_clean`` the input's columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Rolling, blocks, code_points, mixed, per_row, runs, twice, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Largest share of a text's word characters inside duplicated n-grams, by n-gram length, and inside
# duplicated lines: the published limits of large web-corpus filters.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_CHAR_LIMIT = 0.20
# Fixed set of symbols.
SYMBOLS = b"[#*$%&|<>]"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS[1:-1])] = True


def coverage(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Measures of each row of a block, as arrays by column name."""
    found = words(data, offsets)
    n, row, rows = len(found.begin), found.row, len(offsets) - 1
    points = code_points(data)
    chars = points[found.end] - points[found.begin]
    word_chars = per_row(chars, found.first)
    out = {
        "n_words": found.counts, "word_chars": word_chars,
        "n_symbols": per_row(_SYMBOL[data], offsets),
    }
    dup_lines, line_chars = duplicate_lines(data, offsets, found.begin, points)
    out["n_dup_lines"] = dup_lines
    room = found.first[1:][row] - np.arange(n)  # words from here to the end of the row
    rolling = Rolling(mixed(found.codes))
    salt = mixed(row + (1 << 40))

    def covered(size: int, with_first: bool = False) -> np.ndarray:
        start = np.flatnonzero(room >= size)
        keys = rolling.windows(size)[start] ^ salt[start]
        again = np.flatnonzero(twice(keys))
        if not with_first:
            later = np.ones(len(again), bool)
            later[np.unique(keys[again], return_index=True)[1]] = False
            again = again[later]
        hit = start[again]
        edge = np.zeros(n + 1, np.int64)
        edge[hit] += 1
        edge[hit + size] -= 1
        return np.cumsum(edge[:-1]) > 0

    out["n_repeat_words"] = per_row(covered(3, with_first=True), found.first)
    base = np.maximum(word_chars, 1)
    bad = line_chars > LINE_CHAR_LIMIT * base
    out["dup_line_share"] = line_chars / base
    for size, limit in NGRAM_LIMITS.items():
        share = per_row(chars * covered(size), found.first) / base
        out[f"dup_{size}gram_share"] = share
        bad |= share > limit
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (
        100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    out["kept"] = ~(out["base_failed"] | bad)
    assert all(len(v) == rows for v in out.values())
    return out


def duplicate_lines(data, offsets, word_begin, points) -> tuple[np.ndarray, np.ndarray]:
    """Per row: lines with a word that equal an earlier line byte by byte, and their characters."""
    rows = len(offsets) - 1
    begin, end = runs(data != 10, offsets)
    flat = data[data != 10]
    places = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(end - begin, out=places[1:])
    lines = pa.Array.from_buffers(pa.large_binary(), len(begin), [
        None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(flat))]).dictionary_encode()
    code = lines.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.searchsorted(offsets, begin, side="right") - 1
    has_word = np.searchsorted(word_begin, end) > np.searchsorted(word_begin, begin)
    again = np.ones(len(begin), bool)
    again[np.unique(row * max(len(lines.dictionary), 1) + code, return_index=True)[1]] = False
    again &= has_word
    length = points[end] - points[begin]
    return (np.bincount(row[again], minlength=rows),
            np.bincount(row[again], weights=length[again], minlength=rows).astype(np.int64))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = ("dup_line_share", *(f"dup_{n}gram_share" for n in NGRAM_LIMITS))
FLAGS = ("base_failed", "kept")


def _measure(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in blocks(batches, "text"):
        found = coverage(data, offsets)
        columns = [pa.array(found[c].astype(np.int64)) for c in COUNTS]
        columns += [pa.array(found[c].astype(np.float64)) for c in SHARES]
        columns += [pa.array(found[c]) for c in FLAGS]
        yield pa.RecordBatch.from_arrays([rows.column(0), *columns], [key, *COUNTS, *SHARES, *FLAGS])


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, counts, shares, base_failed, kept): one row for each input row."""
    kind = dict(docs.dtypes)[key]
    schema = ", ".join([f"`{key}` {kind}", *(f"{c} bigint" for c in COUNTS),
                        *(f"{c} double" for c in SHARES), *(f"{c} boolean" for c in FLAGS)])
    return (docs.select(F.col(key), F.col(text).alias("text"))
            .mapInArrow(partial(_measure, key=key), schema))


def _clean(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in blocks(batches, text):
        yield rows.filter(pa.array(coverage(data, offsets)["kept"]))


def keep_clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text passes, with all their columns as they are."""
    return docs.mapInArrow(partial(_clean, text=text), docs.schema)
