"""SentencePiece BPE encoding that keeps offsets, and decoding.

A text is normalised by the model's compiled character map: at each place the longest key of its
trie is replaced, any other character stays. Every normalised character remembers the byte of the
source where it began, so each piece projects to a span of source bytes. Pieces are formed by merges
in order of score, from the left among equals, in stretches that begin with white space: no piece of
a model holds white space after another character, which is checked, so no merge crosses stretches.
The distinct stretches of a block are merged all at once: one row of numbers each, in arrays by
length, with a sorted table of the pairs that make a piece; each step merges the best pair of every row.
Stretches of more than LONG_STRETCH characters go one by one, by a heap of their pairs.

Defined results: a null or empty text has no pieces but the end id, if that is asked for; equal
texts get equal ids; texts are encoded whole, a stretch without white space of any length in
n log n steps; characters without a piece become bytes or the unknown id; the pieces of one
character's bytes all span that character; rows with null keys are rows like others; an empty table
gives an empty result; the output has the key and the operator's own columns alone, so names
can't clash.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import blocks, release_memory

SPACE = "▁"
STRETCH = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
LONG_STRETCH = 48
BLOCK = 1_000_000
# Fixed values of the model format: kinds of pieces, and the model type of BPE.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE, BPE = 1, 2, 3, 4, 5, 6, 2


class CharacterMap:
    """Longest-prefix replacement by a compiled character map: a double array and its strings."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.strings = blob[4 + size:]
        self.leads = {c for c in range(256) if self._step(self._root(), c) is not None}

    def _root(self) -> int:
        return self._base(self.units[0]) if self.units else 0

    @staticmethod
    def _base(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _step(self, place: int, byte: int) -> int | None:
        """The unit that ``byte`` leads to from the children at ``place``."""
        at = place ^ byte
        if at >= len(self.units) or self.units[at] & 0x800000FF != byte:
            return None
        return at

    def longest(self, data: bytes, start: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that ``data`` has at ``start``."""
        place, found = self._root(), None
        for i in range(start, len(data)):
            at = self._step(place, data[i])
            if at is None:
                break
            unit = self.units[at]
            place = at ^ self._base(unit)
            if unit >> 8 & 1:
                found = i + 1 - start, self.units[place] & 0x7FFFFFFF
        if found is None:
            return None
        length, first = found
        return length, self.strings[first:self.strings.index(b"\0", first)]

    def apply(self, data: bytes) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters the source byte it began at."""
        raw = np.frombuffer(data, np.uint8)
        starts = np.flatnonzero((raw & 0xC0) != 0x80)
        if not self.leads or self.leads.isdisjoint(data):
            return data.decode(), starts
        out, source, at = [], [], 0
        ends = np.append(starts[1:], len(data)).tolist()
        ends = dict(zip(starts.tolist(), ends))
        while at < len(data):
            hit = self.longest(data, at) if data[at] in self.leads else None
            step, text = (hit[0], hit[1].decode()) if hit else (
                ends[at] - at, data[at:ends[at]].decode())
            out.append(text)
            source += [at] * len(text)
            at += step
        return "".join(out), np.array(source, np.int64)


class Pairs:
    """Which neighbours make a piece, as a sorted table of pairs of numbers, and merges by it.

    A number is a piece's id, or for a character without a piece the number of pieces and its code point.
    """

    NONE = np.iinfo(np.int32).max

    def __init__(self, known: dict[str, tuple[float, int]], pieces: list[str]):
        self.size = len(pieces)
        self.single = {ord(p): i for p, (_, i) in known.items() if len(p) == 1}
        self.of_point: np.ndarray | None = None

        def number(part: str) -> int | None:
            found = known.get(part)
            return found[1] if found else ord(part) + self.size if len(part) == 1 else None
        places = {s: k for k, s in enumerate(sorted({s for s, _ in known.values()}))}
        rows = [(a << 32 | b, places[s], i) for p, (s, i) in known.items() for k in range(1, len(p))
                if (a := number(p[:k])) is not None and (b := number(p[k:])) is not None]
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        self.keys = table[:, 0].copy()
        self.ranks, self.results = (table[:, k].astype(np.int32) for k in (1, 2))

    def prepare(self) -> None:
        """The number of every code point, once in a task."""
        if self.of_point is None:
            self.of_point = np.arange(0x110000, dtype=np.int64) + self.size
            self.of_point[list(self.single)] = list(self.single.values())

    def found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank, NONE if they make no piece, and piece of each pair; -1 is no neighbour."""
        if not len(self.keys):
            return np.full(left.shape, self.NONE, np.int64), np.zeros(left.shape, np.int64)
        key = left << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], self.NONE), self.results[at]

    def merged(self, stretches: list[str], size: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """The numbers of stretches after all merges, best rank first, the leftmost of equals: parts of
        (which stretches, numbers in rows, how many in each row)."""
        out: list[tuple[np.ndarray, ...]] = []
        low = 0
        for high in (4, 6, 8, 12, 18, 28, LONG_STRETCH):
            for part in np.array_split(mine := np.flatnonzero((size > low) & (size <= high)),
                                       1 + len(mine) * high // 500_000):
                if len(part):
                    self._merge([stretches[i] for i in part], size[part], high, part, out)
            low = high
        return out

    def _merge(self, stretches: list[str], size: np.ndarray, width: int, names: np.ndarray,
               out: list[tuple[np.ndarray, ...]]) -> None:
        points = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), "<u4")
        place = np.arange(width + 1)
        now = np.full((len(size), width + 1), -1, np.int64)
        now[place < size[:, None]] = self.of_point[points]
        rank, piece = self.found(now[:, :-1], now[:, 1:])
        size = size.copy()
        while len(names):
            at = rank.argmin(1)
            row = np.arange(len(names))
            able = rank[row, at] < self.NONE
            if not able.all():
                out.append((names[~able], now[~able, :size[~able].max()], size[~able]))
                if not able.any():
                    return
                now, rank, piece, size, names, at = (a[able] for a in (now, rank, piece, size, names, at))
                row = np.arange(len(names))
            now[row, at] = piece[row, at]
            from_next = place[:-1] > at[:, None]
            now[:, :-1] = np.where(from_next, now[:, 1:], now[:, :-1])
            # The pair itself goes, those behind it move up, those beside it are new.
            from_next = place[:-2] >= at[:, None]
            for table in (rank, piece):
                table[:, :-1] = np.where(from_next, table[:, 1:], table[:, :-1])
            rank[:, -1] = self.NONE
            size -= 1
            rank[row, at], piece[row, at] = self.found(now[row, at], now[row, at + 1])
            before = np.flatnonzero(at > 0)
            b = at[before] - 1
            rank[before, b], piece[before, b] = self.found(now[before, b], now[before, b + 1])


@dataclass
class Codec:
    """Encoder and decoder of one model. Small enough to travel with a task."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    charmap: bytes
    prefix: bool
    squeeze: bool
    end_id: int
    unknown_id: int
    by_byte: bool
    known: dict = field(default=None, repr=False)
    pairs: Pairs = field(default=None, repr=False)

    @classmethod
    def load(cls, path: str) -> Codec:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, train = model.normalizer_spec, model.trainer_spec
        kinds = [p.type for p in model.pieces]
        inner = any(SPACE in p.piece.lstrip(SPACE) for p in model.pieces if p.type == NORMAL)
        if train.model_type != BPE or inner or {USER, UNUSED} & set(kinds) \
                or not norm.escape_whitespaces or train.treat_whitespace_as_suffix \
                or model.denormalizer_spec.precompiled_charsmap:
            raise ValueError("only BPE models with white space before words can be read")
        codec = cls([p.piece for p in model.pieces], [p.score for p in model.pieces], kinds,
                    norm.precompiled_charsmap, norm.add_dummy_prefix,
                    norm.remove_extra_whitespaces, train.eos_id, train.unk_id, train.byte_fallback)
        codec.pairs = Pairs(codec._normal(), codec.pieces)  # travels with the tasks
        return codec

    def _normal(self) -> dict[str, tuple[float, int]]:
        """The pieces that merges may give, with their negative score and id."""
        return {p: (-s, i) for i, (p, s, k) in enumerate(zip(self.pieces, self.scores, self.kinds))
                if k == NORMAL}

    def prepare(self) -> Codec:
        """Build the lookup tables, once in a task."""
        if self.known is None:
            self.map = CharacterMap(self.charmap)
            self.known = self._normal()
            self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(
                zip(self.pieces, self.kinds)) if k == BYTE}
            self.special = set()
            written = [f"{i} ".encode() for i in range(len(self.pieces))]
            self.decimals = np.frombuffer(b"".join(written), np.uint8)
            self.decimals_at = np.cumsum([0, *map(len, written)])
            self.widths = np.array([self._width(i) for i in range(len(self.pieces))], np.int64)
            self.pairs = self.pairs or Pairs(self.known, self.pieces)
            self.pairs.prepare()
        return self

    def _width(self, i: int) -> int:
        """Characters a piece takes; of the bytes of one character the first has it."""
        if self.kinds[i] == BYTE:
            return int(not 0x80 <= int(self.pieces[i][3:5], 16) < 0xC0)
        return 1 if self.kinds[i] == UNKNOWN else len(self.pieces[i])

    def normalise(self, data: bytes) -> tuple[str, np.ndarray]:
        """The text the pieces are formed of, and each character's source byte with the end."""
        text, source = self.map.apply(data)
        end = len(data)
        if self.squeeze:
            keep = np.array([c != " " or i and text[i - 1] != " " for i, c in enumerate(text)], bool)
            while len(keep) and keep.any() and text[np.flatnonzero(keep)[-1]] == " ":
                last = np.flatnonzero(keep)[-1]
                keep[last], end = False, int(source[last])
            text, source = "".join(c for c, k in zip(text, keep) if k), source[keep]
        text = text.replace(" ", SPACE)
        if text and self.prefix:
            text, source = SPACE + text, np.concatenate([source[:1], source])
        return text, np.append(source, end)

    def merge(self, stretch: str) -> list[str]:
        """Merge neighbours by score, the leftmost of equals first, as long as a piece results."""
        parts, known = list(stretch), self.known
        if len(parts) > LONG_STRETCH:
            return self._merge_long(parts)
        pairs = [known.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, pair in enumerate(pairs):
                if pair is not None and (best is None or pair[0] < best):
                    best, at = pair[0], i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = known.get(parts[at - 1] + parts[at])
            if at < len(pairs):
                pairs[at] = known.get(parts[at] + parts[at + 1])

    def _merge_long(self, parts: list[str]) -> list[str]:
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list = []

        def offer(a: int) -> None:
            b = after[a]
            if b < n and (pair := self.known.get(parts[a] + parts[b])):
                heapq.heappush(heap, (pair[0], a, len(parts[a]), len(parts[b])))
        for i in range(n):
            offer(i)
        while heap:
            _, a, left, right = heapq.heappop(heap)
            b = after[a]
            if len(parts[a]) != left or b >= n or len(parts[b]) != right:
                continue
            parts[a] += parts[b]
            parts[b] = ""
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [p for p in parts if p]

    def piece_ids(self, stretch: str) -> list[int]:
        """The ids of one stretch by ``merge``."""
        ids = []
        for part in self.merge(stretch):
            piece = self.known.get(part)
            ids += [piece[1]] if piece else self.without_piece(part)
        return ids

    def without_piece(self, part: str) -> list[int]:
        """The ids of a character that is no piece."""
        return [self.bytes[b] for b in part.encode()] if self.by_byte else [self.unknown_id]

    def stretch_ids(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the stretches end to end, and where each begins."""
        length = np.fromiter(map(len, stretches), np.int64, len(stretches))
        short = np.flatnonzero(length <= LONG_STRETCH)
        parts = [(short[names], now, size) for names, now, size in self.pairs.merged(
            [stretches[i] for i in short], length[short])]
        # What has a character without a piece, or is long, one by one.
        apart = {int(i): self.piece_ids(stretches[i]) for i in np.flatnonzero(length > LONG_STRETCH)}
        count = np.zeros(len(stretches) + 1, np.int64)
        for names, now, size in parts:
            count[names + 1] = size
            for k in np.flatnonzero((now >= len(self.pieces)).any(1)):
                apart[int(names[k])] = [i for part in now[k, :size[k]].tolist() for i in (
                    [part] if part < len(self.pieces) else self.without_piece(chr(part - len(self.pieces))))]
        for i, ids in apart.items():
            count[i + 1] = len(ids)
        first = np.cumsum(count)
        flat = np.zeros(first[-1], np.int32)
        for names, now, size in parts:
            place = np.arange(now.shape[1])
            plain = (place < size[:, None]) & ~(now >= len(self.pieces)).any(1)[:, None]
            flat[(first[names][:, None] + place)[plain]] = now[plain]
        for i, ids in apart.items():
            flat[first[i]:first[i + 1]] = ids
        return flat, first

    def written(self, ids: np.ndarray) -> str:
        """The ids in decimal, with single spaces between."""
        start = self.decimals_at[ids]
        return self.decimals[ranges(start, self.decimals_at[ids + 1] - start)].tobytes()[:-1].decode()

    def decoded(self, ids: list[int]) -> str:
        """The pieces' text end to end, with white space as spaces."""
        if not self.special:
            self.plain = [p.replace(SPACE, " ") for p in self.pieces]
            self.special = {i for i, k in enumerate(self.kinds) if k != NORMAL}
        if self.special.isdisjoint(ids):
            return "".join([self.plain[i] for i in ids])
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i is not None and self.kinds[i] == BYTE:
                run.append(int(self.pieces[i][3:5], 16))
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if i is not None and self.kinds[i] != CONTROL:
                out.append(" ⁇ " if self.kinds[i] == UNKNOWN else self.plain[i])
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.decoded(ids)
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        led = first is not None and self.pieces[first].startswith(SPACE)
        return text[1:] if led and (self.prefix or self.squeeze) else text

    def encode(self, texts: list[bytes], writing: bool = True
               ) -> Iterator[tuple[np.ndarray, str, np.ndarray]]:
        """Of each text the ids, with ``writing`` the ids in decimal, and each piece's (begin, end) in
        source bytes."""
        normal = [self.normalise(t) for t in texts]
        number: dict[str, int] = {}
        codes = [np.array([number.setdefault(s, len(number)) for s in STRETCH.findall(text)], np.int64)
                 for text, _ in normal]
        flat, first = self.stretch_ids(list(number))
        size = np.diff(first)
        for (_, source), own in zip(normal, codes):
            ids = flat[ranges(first[own], size[own])]
            width = self.widths[ids]
            end = np.cumsum(width)
            begin = end - np.maximum(width, 1)
            yield (ids, self.written(ids) if writing else "",
                   np.stack([source[begin], source[end]], 1))


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each pair, end to end."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def _texts(batches: Iterator[pa.RecordBatch]):
    for rows, data, offsets in blocks(batches, "text", BLOCK):
        raw = data.tobytes()
        yield rows, [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _encoded(batches, codec: Codec, end: bool, spans: bool):
    codec.prepare()
    for rows, texts in _texts(batches):
        ids, places = [], []
        for text, (own, _, where) in zip(texts, codec.encode(texts, writing=False)):
            ids.append(np.append(own, codec.end_id).astype(np.int32) if end else own)
            if spans:
                places.append(np.concatenate([where, np.full((int(end), 2), len(text))]))
        columns = [rows.column(0), pa.array(ids, pa.list_(pa.int32()))]
        if spans:
            columns += [pa.array([p[:, k] for p in places], pa.list_(pa.int64())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "begins", "ends"][:len(columns)])
    release_memory()


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text",
           end: bool = True, spans: bool = True) -> DataFrame:
    """(id, ids, begins, ends): pieces and, with ``spans``, their spans in bytes of the source."""
    codec = Codec.load(model)
    places = ", begins array<bigint>, ends array<bigint>" if spans else ""
    kind = dict(docs.dtypes)[key]
    return (docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(lambda batches: _encoded(batches, codec, end, spans),
                        f"id {kind}, ids array<int>{places}"))


def _decoded(batches, codec: Codec):
    codec.prepare()
    for batch in batches:
        texts = [codec.decode(ids or []) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                         ["id", "text"])


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(id, text) of a frame with id and ids."""
    codec = Codec.load(model)
    kind = dict(encoded.dtypes)["id"]
    return encoded.select("id", "ids").mapInArrow(lambda batches: _decoded(batches, codec),
                                                  f"id {kind}, text string")


def _digests(batches, codec: Codec, end: bool):
    """Hashes of what ``encode`` and ``decode`` give, without writing the pieces out."""
    codec.prepare()
    for rows, texts in _texts(batches):
        out = []
        for ids, written, spans in codec.encode(texts):
            if end:
                written = f"{written} {codec.end_id}" if written else str(codec.end_id)
            decoded = codec.decode(ids.tolist())
            out.append((len(ids) + int(end), hashlib.sha256(written.encode()).hexdigest(),
                        hashlib.sha256(decoded.encode()).hexdigest(),
                        hashlib.sha256(spans.astype("<i8").tobytes()).hexdigest()))
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(columns[0], pa.int64()),
             *[pa.array(c, pa.string()) for c in columns[1:]]],
            ["id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])
    release_memory()


def digests(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text",
            end: bool = True) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, spans_sha256) of the pieces of each text."""
    codec = Codec.load(model)
    kind = dict(docs.dtypes)[key]
    return (docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(lambda batches: _digests(batches, codec, end),
                        f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
                        "spans_sha256 string"))
