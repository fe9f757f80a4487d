"""Licence scans by a positional index of rare words.

Templates are short notices with mandatory key phrases, and bare phrases that are found as they are.
How many documents hold each template word is counted over all of them; that gives the inverse document
frequencies by which a template's ANCHORS highest words are listed with their positions. A file's words
are looked up there from the rarest on: an occurrence says where the template would have to start. The
postings of a template are intersected by that start:

* a phrase stands where all its anchors agree on one start and all its words then are there;
* a notice stands where anchors of at least NEEDED of the anchors' weight agree on a start up to SLACK
  words, as a few inserted or missing words shift the rest, and where all its key phrases stand between
  its ends. Key phrases are phrases of the same index.

The share of a notice is the anchors' weight that was found, that of a phrase 1. A file's score is its
largest share; a notice whose key phrases are missing counts half and gives no label.

The counts are one scan with one row a template word and task; the search is one scan without a
shuffle. The index is as large as the templates, whatever the data.

Defined results: a null or empty text has no words, no place and score 0; each row is scanned by
itself, so repeated rows and ties of keys give equal rows; a text of any length is read whole; equal
frequencies go by word order; an empty table gives an empty result; only the key and the text of a row
are read, so further columns never clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import _LOWER, Words, blocks, pieces, runs

ANCHORS = 8
NEEDED = 0.6
SLACK = 4
# Label and words of the phrases that are a licence by themselves.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Label, notice and mandatory key phrases, in the words of the public licences.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files the software to deal in the software without restriction",
     ("to deal in the software without restriction",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or "
            "without fee is hereby granted provided that the above copyright notice and this permission "
            "notice appear in all copies", ("with or without fee is hereby granted",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met",
     ("redistribution and use in source and binary forms",)),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file "
                 "except in compliance with the license", ("apache license", "version 2 0")),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of "
            "the gnu general public license as published by the free software foundation",
     ("gnu general public license",)),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of "
             "the gnu lesser general public license as published by the free software foundation",
     ("gnu lesser general public license",)),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of "
             "the gnu affero general public license as published by the free software foundation",
     ("gnu affero general public license",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the "
              "eclipse public license 2 0", ("eclipse public license",)),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy "
              "of the software and accompanying documentation covered by this license",
     ("person or organization obtaining a copy",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the "
             "authors be held liable for any damages arising from the use of this software",
     ("in no event will the authors be held liable",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("unencumbered software released into the public domain",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution 4 0",)),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international "
                 "license", ("creative commons attribution sharealike",)),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 "
                 "international license", ("creative commons attribution noncommercial",)),
)
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of digits, letters and everything beyond ASCII, A-Z lower-cased."""
    data = _LOWER[data]
    inside = _INSIDE[data]
    begin, end = runs(inside, offsets)
    coded = pieces(data, begin, end, inside).dictionary_encode()
    return Words(begin, end, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                 coded.dictionary, np.searchsorted(begin, offsets))


def vocabulary(phrases=PHRASES, notices=NOTICES) -> list[str]:
    """Every word of a template, in order."""
    texts = [t for _, t in phrases] + [t for _, t, _ in notices] + [k for *_, ks in notices for k in ks]
    return sorted({w for t in texts for w in t.split()})


@dataclass(frozen=True)
class Template:
    """Word numbers in order, and the anchors' positions, from the highest weight on."""

    label: str
    words: np.ndarray
    anchors: np.ndarray
    weights: np.ndarray
    keys: tuple[int, ...] = ()  # the phrases of the index that have to stand in a notice


class Index:
    """Positional postings of the templates' rarest words."""

    def __init__(self, documents: int, holding: dict[str, int], phrases=PHRASES, notices=NOTICES):
        self.vocabulary = vocabulary(phrases, notices)
        place = {w: i for i, w in enumerate(self.vocabulary)}
        weight = [math.log((documents + 1) / (holding.get(w, 0) + 1)) + 1 for w in self.vocabulary]

        def template(label: str, text: str, keys: tuple[int, ...] = ()) -> Template:
            codes = np.array([place[w] for w in text.split()])
            order = sorted(range(len(codes)), key=lambda p: (-weight[codes[p]], p))[:ANCHORS]
            return Template(label, codes, np.array(order), np.array(
                [weight[codes[p]] for p in order]), keys)
        wanted = [(label, text) for label, text in phrases]
        extra = list(dict.fromkeys(k for *_, keys in notices for k in keys))
        self.base = len(wanted)
        self.phrases = [template(label, text) for label, text in wanted]
        self.phrases += [template("", text) for text in extra]
        self.notices = [template(label, text, tuple(self.base + extra.index(k) for k in keys))
                        for label, text, keys in notices]

    def scan(self, found: Words) -> list[tuple[int, str, int, int, float, bool]]:
        """(row, label, first word, word behind, share, base) of every place of a block; the label is
        empty where a notice lacks a key phrase."""
        code = pc.index_in(found.vocabulary, pa.array(
            [w.encode() for w in self.vocabulary], pa.large_binary()))
        code = code.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if not (code >= 0).any():
            return []
        codes = code[found.codes]
        at = np.flatnonzero(codes >= 0)
        at = at[np.argsort(codes[at], kind="stable")]
        edges = np.searchsorted(codes[at], np.arange(len(self.vocabulary) + 1))
        row = found.row

        def starts(t: Template, anchor: int) -> np.ndarray:
            """Where the template would start for each occurrence of an anchor."""
            word = t.words[t.anchors[anchor]]
            return at[edges[word]:edges[word + 1]] - t.anchors[anchor]

        def standing(t: Template) -> np.ndarray:
            left = starts(t, 0)  # the rarest word: most phrases end here
            for anchor in range(1, len(t.anchors)):
                if not len(left):
                    return left
                left = np.intersect1d(left, starts(t, anchor), assume_unique=True)
            left = left[(left >= 0) & (left + len(t.words) <= len(codes))]
            ok = row[left] == row[left + len(t.words) - 1]
            for i, word in enumerate(t.words):
                ok &= codes[left + i] == word
            return left[ok]

        places = [standing(t) for t in self.phrases]
        out = [(int(row[s]), t.label, int(s), int(s) + len(t.words), 1.0, True)
               for t, found_at in zip(self.phrases[:self.base], places) for s in found_at]
        for t in self.notices:
            out += [(int(r), t.label if self._keys_stand(t, places, first, last) else "", first, last,
                     share, False) for r, first, last, share in self._aligned(t, starts, row, len(codes))]
        first = found.first
        return [(r, label, a - int(first[r]), b - int(first[r]), share, base)
                for r, label, a, b, share, base in out]

    @staticmethod
    def _aligned(t: Template, starts, row: np.ndarray, n: int):
        """Places where enough anchors agree on a start, within SLACK of the one before."""
        where = [starts(t, a) for a in range(len(t.anchors))]
        start = np.concatenate(where)
        anchor = np.repeat(np.arange(len(where)), [len(w) for w in where])
        word = start + t.anchors[anchor]
        if not len(start):
            return
        order = np.lexsort((start, row[word]))
        start, anchor, word = start[order], anchor[order], word[order]
        new = np.ones(len(start), bool)
        new[1:] = (row[word[1:]] != row[word[:-1]]) | (np.diff(start) > SLACK)
        group = np.cumsum(new) - 1
        have = np.zeros((group[-1] + 1, len(t.anchors)), bool)
        have[group, anchor] = True
        share = have @ t.weights / t.weights.sum()
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(start))
        for g in np.flatnonzero(share >= NEEDED):
            inside = word[begin[g]:end[g]]
            r = int(row[inside[0]])
            low, high = int(inside.min()), int(inside.max()) + 1
            # From the template's start to its end, as far as the row reaches.
            low = min(low, max(int(start[begin[g]]), int(np.searchsorted(row, r))))
            high = max(high, min(int(start[end[g] - 1]) + len(t.words), int(
                np.searchsorted(row, r, side="right"))))
            yield r, low, high, float(share[g])

    def _keys_stand(self, t: Template, places: list[np.ndarray], first: int, last: int) -> bool:
        for key in t.keys:
            i = np.searchsorted(places[key], first)
            if i == len(places[key]) or places[key][i] + len(self.phrases[key].words) > last:
                return False
        return True


def document_frequencies(docs: DataFrame, listed: list[str]) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those that hold each of the listed words."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, names = np.zeros(len(listed) + 1, np.int64), pa.array(
            [w.encode() for w in listed], pa.large_binary())
        for _, data, offsets in blocks(batches, "text"):
            found = words(data, offsets)
            code = pc.index_in(found.vocabulary, names).fill_null(-1).to_numpy(
                zero_copy_only=False).astype(np.int64)
            codes = code[found.codes] if len(found.codes) else found.codes
            held = np.unique(found.row[codes >= 0] * len(listed) + codes[codes >= 0]) % len(listed)
            total[:-1] += np.bincount(held, minlength=len(listed))
            total[-1] += len(offsets) - 1
        yield pa.RecordBatch.from_arrays([pa.array([*listed, None], pa.string()), pa.array(total)],
                                         ["word", "n"])
    rows = (docs.mapInArrow(counted, "word string, n bigint").groupBy("word")
            .agg(F.sum("n").alias("n")).collect())
    holding = {r.word: r.n for r in rows}
    return holding.pop(None, 0), holding


PLACES = "array<struct<label: string, first: bigint, end: bigint, share: double, base: boolean>>"


def licences(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=PHRASES,
             notices=NOTICES) -> DataFrame:
    """(id, n_words, score, places): a row for each document; ``places`` has (label, first, end, share,
    base) by first word and label, in words from 0, the end exclusive."""
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    index = Index(*document_frequencies(rows.select("text"), vocabulary(phrases, notices)),
                  phrases, notices)
    place = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()),
                       ("share", pa.float64()), ("base", pa.bool_())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches, "text"):
            found = words(data, offsets)
            score = np.zeros(len(part))
            places: list[list[dict]] = [[] for _ in range(len(part))]
            for row, label, first, end, share, base in sorted(index.scan(found)):
                score[row] = max(score[row], share if label else share / 2)
                if label:
                    places[row].append({"label": label, "first": first, "end": end, "share": share,
                                        "base": base})
            for held in places:
                held.sort(key=lambda p: (p["first"], p["label"], not p["base"]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(found.counts), pa.array(np.minimum(score, 1.0)),
                 pa.array(places, pa.list_(place))], ["id", "n_words", "score", "places"])
    return rows.mapInArrow(scanned, f"id {kind}, n_words bigint, score double, places {PLACES}")
