"""Personal data by boosted trees over candidate spans.

Generators with high recall propose spans: base patterns, and loose ones for e-mail addresses with
spelled-out signs, card and phone numbers with other separators, network addresses of either
version, identity and account numbers, keys and tokens. Spans may overlap. Each candidate gets
features of its format (length, digits, groups, separators, check digit, octets, entropy) and of its
context (neighbouring characters, words before it).

Texts are read once: a task writes the base spans of each row, its candidates with their features, and its
examples to a table, and gradient-boosted trees are grown by Spark over the examples of all documents,
counted by their features. A feature is one of a fixed row of cells, so equal examples are one counted row.
There are no labels for personal data, so examples come from what validates itself: base matches, account numbers by their remainder to 97, identity numbers by their area, group and serial
rules, and keys after a word that announces one. Base matches are also rewritten in the ways the loose
patterns know, and for the kinds without a base pattern, forms are made up at the place of a match.
Counter-examples are candidates that fail such a rule, and matches and forms broken on purpose; other
candidates of the corpus are no examples, as nothing tells what they are. Texts are dealt by a hash: the
trees are grown on all examples of three quarters of them, and the threshold is the lowest step of a score
at which the precision on all examples of the other quarter reaches TARGET_PRECISION. Base spans stay in any case; a candidate above the
threshold is added where it overlaps no span.

Defined results: a null or empty text has no spans; equal texts get equal spans; texts are searched
whole, in n log n steps whatever the number of spans; of overlapping added spans the better score stays, then the earlier, then the
longer; rows with a null key are rows like others, but not learned from; an empty table gives an
empty result; only key and text are read, so other columns can't clash.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import trees
from .blocks import blocks, per_row
from .store import stored
from .trees import CELLS, Boosted

TARGET_PRECISION = 0.98
APART = 4  # one in so many texts is for the threshold
STEPS = 4096  # of a score, for the threshold
KINDS = ("email", "ip", "card", "phone", "id", "account", "key")
BASE = KINDS[:4]
# Fixed patterns of the base kinds; the local part of an address is found from its sign leftward.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOOSE = {
    "email": re.compile(r"(?<![\w.+-])[\w.+-]{1,64}[ ]?(?:\(at\)|\[at\]| at )[ ]?[\w-]{1,63}"
                        r"(?:[ ]?(?:\.|\(dot\)|\[dot\]| dot )[ ]?[\w-]{2,63}){1,4}"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}([ ./_-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:00[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ ./-]{1,2}[0-9]{3}"
                        r"[ ./-][0-9]{4}(?![0-9])"),
    "ip": re.compile(r"(?<![0-9a-fA-F:])(?:[0-9a-fA-F]{1,4}:){5,7}[0-9a-fA-F]{1,4}"
                     r"(?![0-9a-fA-F:])"),
    "id": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "account": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){3,7}"
                          r"(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "key": re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9_-]{24,}+(?![A-Za-z0-9])"),
}
CUES = {
    "email": ("mail", "contact", "write"), "phone": ("phone", "tel", "call", "fax", "mobil"),
    "card": ("card", "visa", "credit", "pay"), "ip": ("ip", "host", "server", "address"),
    "id": ("ssn", "social", "identity"), "account": ("iban", "account", "bank"),
    "key": ("token", "key", "secret", "passw", "auth"),
}
DIGITS = re.compile(r"[0-9]")
# Where the cells of a number begin, and those of the entropy, which is feature ENTROPY of FEATURES.
SIZES = np.array([*range(1, 21), 22, 24, 28, 32, 36, 40, 48, 64, 80, 128, 256], float)
BITS = np.arange(1, CELLS) / 5
FEATURES, ENTROPY = 22, 15


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def small_octets(text: str) -> bool:
    return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def account(text: str) -> bool:
    """Whether an account number leaves a remainder of 1 to 97."""
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def identity(text: str) -> bool:
    """Whether area, group and serial number of an identity number are ones that are given out."""
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def digits_of(text: str) -> str:
    return "".join(DIGITS.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        sign = text.find("@", max(done, sign + 1))


def proposals(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, valid) of the base patterns' matches, in order of kind."""
    out = [("email", a, b, True) for a, b in emails(text)]
    out += [("ip", *m.span(), small_octets(m[0])) for m in IP.finditer(text)]
    for kind, pattern in (("card", CARD), ("phone", PHONE)):
        for m in pattern.finditer(text):
            digits = digits_of(m[0])
            fits = (14 <= len(digits) <= 19 and luhn(digits) if kind == "card"
                    else 10 <= len(digits) <= 15)
            out.append((kind, *m.span(), fits))
    return out


def loose(text: str) -> list[tuple[str, int, int]]:
    """Matches of the loose patterns; a key has at least one digit."""
    return [(kind, *m.span()) for kind, pattern in LOOSE.items() for m in pattern.finditer(text)
            if kind != "key" or DIGITS.search(m[0])]


class Taken:
    """Spans that are used up, as disjoint ones in order."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        i = bisect_right(self.ends, a)
        return i < len(self.ends) and self.starts[i] < b

    def add(self, a: int, b: int) -> None:
        """Take a span that meets no other."""
        i = bisect_right(self.ends, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


LEAST_DIGITS = 7


def _hopeless(kind: str, span: str) -> bool:
    """A failed match that can't be a candidate: too few digits, or an address with a part beyond
    255, which is no address in any context."""
    return kind == "ip" or len(digits_of(span)) < LEAST_DIGITS


def _class(c: str) -> int:
    return (0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit()
            else 4 if c in "\"'([{" else 5 if c in ".,;:!?)]}" else 6)


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    span, before = text[start:end], text[max(0, start - 24):start].lower()
    digits = digits_of(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    letters = sum(c.isalpha() for c in span)
    others = [c for c in span if not c.isalnum()]
    counts = [span.count(c) / len(span) for c in set(span)]
    octets = span.split(".")
    cues = [float(any(c in before for c in CUES[k])) for k in KINDS]
    return [float(KINDS.index(kind)), len(span), len(digits), letters, len(others),
            len(set(others)), len(groups), max(groups, default=0), min(groups, default=0),
            float(len(digits) >= 12 and luhn(digits)),
            float(len(octets) == 4 and all(o.isdigit() for o in octets) and small_octets(span)),
            float(span.startswith("+")), float("@" in span), float("(" in span),
            float(bool(digits) and letters > 0),
            -sum(p * np.log2(p) for p in counts), _class(text[start - 1:start] if start else ""),
            _class(text[end:end + 1]), float(kind == "account" and account(span)),
            float(kind == "id" and identity(span)), cues[KINDS.index(kind)], sum(cues)]


def cells(found: list[list[float]]) -> np.ndarray:
    """The cells of lists of features."""
    x = np.array(found, float).reshape(-1, FEATURES)
    out = np.searchsorted(SIZES, x, side="right")
    out[:, ENTROPY] = np.searchsorted(BITS, x[:, ENTROPY], side="right")
    return out.astype(np.uint8)


def rewritten(kind: str, span: str, draw: random.Random) -> str:
    """A genuine span in a form that only the loose patterns know."""
    if kind == "email":
        at, dot = draw.choice([("(at)", "."), (" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) ")])
        name, _, domain = span.rpartition("@")
        return f"{name}{at}{dot.join(domain.split('.')[-5:])}"
    digits = digits_of(span)
    if kind == "card":
        mark = draw.choice(" ./_-")
        return mark.join([digits[:4], digits[4:8], digits[8:12], digits[12:]])
    if kind == "phone":
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return draw.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"001 {a} {b} {c}"])
    return made(kind, draw)


def made(kind: str, draw: random.Random) -> str:
    """A genuine span of a kind that has no base pattern, or an address of version 6."""
    if kind == "ip":
        return ":".join(f"{draw.getrandbits(16):x}" for _ in range(8))
    if kind == "id":
        area = draw.choice([draw.randrange(1, 666), draw.randrange(667, 900)])
        return f"{area:03}-{draw.randrange(1, 100):02}-{draw.randrange(1, 10_000):04}"
    if kind == "account":
        land = "".join(draw.choice("ABCDEFGHIKLMNOPRST") for _ in range(2))
        inner = "".join(draw.choice("0123456789") for _ in range(draw.randrange(12, 25)))
        if draw.random() < 0.4:
            inner = "".join(draw.choice("ABCDEFGHKLMNPQRS") for _ in range(4)) + inner[4:]
        check = 98 - int("".join(str(int(c, 36)) for c in f"{inner}{land}00")) % 97
        plain = f"{land}{check:02}{inner}"
        return draw.choice([plain, " ".join(plain[i:i + 4] for i in range(0, len(plain), 4))])
    sizes, signs = (32, 40, 48, 64, 128, 160, 256), "0123456789abcdef"
    if draw.random() < 0.5:
        signs += "ghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_-"
    return "".join(draw.choice(signs) for _ in range(draw.choice(sizes) - 1)) + draw.choice("0123456789")


def broken(kind: str, span: str, draw: random.Random) -> str:
    """A look-alike that is no personal data."""
    digits = digits_of(span)
    if kind == "email":
        return draw.choice(["meet at noon dot then", "look at this dot that", "sat at home dot now",
                            f"{draw.choice(['look', 'meet', 'was'])} at {draw.choice(['noon', 'home', 'once'])}"
                            f". {draw.choice(['Then', 'In', 'Later'])}"])
    if kind == "id":
        return draw.choice([f"{draw.choice(['000', '666', draw.randrange(900, 1000)])}-"
                            f"{draw.randrange(1, 100):02}-{draw.randrange(1, 10_000):04}",
                            f"{draw.randrange(1, 666):03}-00-{draw.randrange(1, 10_000):04}",
                            f"{draw.randrange(1, 666):03}-{draw.randrange(1, 100):02}-0000"])
    if kind == "account":
        return f"{span[:2]}{(int(span[2:4]) + draw.randrange(1, 90)) % 97:02}{span[4:]}"
    if kind == "ip" and ":" in span:
        return ":".join(f"{draw.randrange(60):02}" for _ in range(draw.randrange(6, 9)))
    if kind == "ip":
        return draw.choice([f"{draw.randrange(1, 9)}.{draw.randrange(20)}.{draw.randrange(9)}",
                            ".".join(str(draw.randrange(256, 999)) for _ in range(4))])
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + draw.randrange(1, 10)) % 10)
        return draw.choice([wrong, " ".join(wrong[i:i + 4] for i in range(0, len(wrong), 4))])
    if kind == "phone":
        return draw.choice([f"{draw.randrange(100, 999)}.{draw.randrange(100, 999)}.{draw.randrange(10**3, 10**4)}/x",
                            f"+{digits[:5]}", f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}"])
    parts = ["".join(draw.choice("etaoinshr") for _ in range(draw.randrange(3, 9)))
             for _ in range(max(8, len(span) // 6))]
    return draw.choice(["", "-", "_"]).join([*parts, draw.choice(["", str(draw.randrange(1990, 2040))])])


def _validated(text: str, kind: str, start: int, end: int) -> int | None:
    """Label of a candidate of the corpus by what it shows itself, or None if it shows nothing."""
    span = text[start:end]
    if kind == "email" and " at " in span and ". " in span:
        return 0  # a sentence that ends
    if kind == "account":
        return int(account(span))
    if kind == "id":
        return int(identity(span))
    if kind == "card":
        return int(luhn(digits_of(span)))
    if kind == "ip" and span.count(":") != 7:
        return 0
    if kind == "key" and features(text, kind, start, end)[-2] > 0:
        return 1
    return None


def examples(text: str, seed: int = 1,
             found: tuple[list, list] | None = None) -> list[tuple[list[float], int]]:
    """Self-validated examples from one text: (features, label). ``found`` are the text's proposals and
    loose matches, if they are known."""
    out, draw = [], random.Random(len(text) * 31 + seed)
    found, likely = found or (proposals(text), loose(text))
    taken = Taken((a, b) for _, a, b, fits in found if fits)
    for kind, a, b, fits in found:
        if not fits and _hopeless(kind, text[a:b]):
            continue
        out.append((features(text, kind, a, b), int(fits)))
        if not fits:
            continue
        extra = draw.choice(("ip", "id", "account", "key"))
        genuine = made(extra, draw)
        forms = [(kind, rewritten(kind, text[a:b], draw), 1), (kind, broken(kind, text[a:b], draw), 0),
                 (kind, broken(kind, text[a:b], draw), 0), (extra, genuine, 1),
                 (extra, broken(extra, genuine, draw), 0)]
        for own, new, label in forms:
            # A form of another kind is announced as its kind, or by nothing.
            cue = "" if own == kind else draw.choice(["", f"{draw.choice(CUES[own])} "])
            before = text[max(0, a - 40):a] if own == kind else f"{text[max(0, a - 80):max(0, a - 40)]} {cue}"
            after = text[b:b + 40] if own == kind else f" {text[b + 40:b + 80]}"
            changed, at = f"{before}{new}{after}", len(before)
            for k, x, y in loose(changed) + [p[:3] for p in proposals(changed)
                                             if p[3] or not _hopeless(p[0], changed[p[1]:p[2]])]:
                if x < at + len(new) and y > at:
                    out.append((features(changed, k, x, y), label if k == own else 0))
    for kind, a, b in likely:
        if not taken.meets(a, b):
            label = _validated(text, kind, a, b)
            if label is not None:
                out.append((features(text, kind, a, b), label))
    return out


def _wanted(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that can have a candidate: with a digit, an @ sign or a spelled-out one."""
    hit = (data == 64) | ((data >= 48) & (data <= 57))
    if len(data) > 3:
        a, t = data[1:-2] == 97, data[2:-1] == 116
        left, right = data[:-3], data[3:]
        hit[:-3] |= a & t & (((left == 40) & (right == 41)) | ((left == 91) & (right == 93))
                             | ((left == 32) & (right == 32)))
    return per_row(hit, offsets) > 0


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
CANDIDATE = pa.struct([*SPAN, ("cells", pa.binary())])
COUNTED = pa.struct([("cells", pa.binary()), ("zeros", pa.int64()), ("ones", pa.int64())])
SCANNED = ("apart boolean, base array<struct<kind: string, start: bigint, end: bigint>>, "
           "more array<struct<kind: string, start: bigint, end: bigint, cells: binary>>, "
           "examples array<struct<cells: binary, zeros: bigint, ones: bigint>>")


def _scanned(batches):
    for rows, data, offsets in blocks(batches, "text"):
        raw, apart = data.tobytes(), np.zeros(len(rows), bool)
        base, more, shown = ([[] for _ in range(len(rows))] for _ in range(3))
        for i in np.flatnonzero(_wanted(data, offsets)):
            own = raw[offsets[i]:offsets[i + 1]]
            text = own.decode()
            sure, likely, found = searched(text)
            base[i] = [dict(zip(("kind", "start", "end"), c)) for c in sure]
            places = cells([features(text, *c) for c in likely])
            more[i] = [dict(zip(("kind", "start", "end", "cells"), (*c, x.tobytes())))
                       for c, x in zip(likely, places)]
            learned = examples(text, found=found)
            counted = Counter((x.tobytes(), y) for x, (_, y) in
                              zip(cells([f for f, _ in learned]), learned))
            shown[i] = [{"cells": x, "zeros": n * (1 - y), "ones": n * y} for (x, y), n in counted.items()]
            apart[i] = zlib.crc32(own) % APART == 0
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(apart), pa.array(base, pa.list_(SPAN)),
             pa.array(more, pa.list_(CANDIDATE)), pa.array(shown, pa.list_(COUNTED))],
            ["id", "apart", "base", "more", "examples"])


def scanned(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, apart, base, more, examples) of every row: base spans, candidates with their cells, and
    counted examples. ``apart`` marks texts whose examples are for the threshold."""
    kind = dict(docs.dtypes)[key]
    return stored(docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
                  .mapInArrow(_scanned, f"id {kind}, {SCANNED}"), "personal-data")


def counted(rows: DataFrame) -> DataFrame:
    """(apart, cells, zeros, ones): all examples of all rows with a key, counted."""
    found = rows.where("id IS NOT NULL").select("apart", F.inline("examples"))
    # Dealt to as many parts as can be read at once: each round of the trees reads them.
    return stored(found.groupBy("apart", "cells").agg(F.sum("zeros").alias("zeros"),
                                                      F.sum("ones").alias("ones"))
                  .repartition(rows.sparkSession.sparkContext.defaultParallelism, "cells"),
                  "personal-data-examples")


def _steps(batches, model: Boosted):
    """(step, zeros, ones): counted examples by their score's step."""
    for batch in batches:
        x = trees.matrix(batch.column(0), FEATURES)
        step = (model.score(x) * STEPS).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(step), batch.column(1), batch.column(2)],
                                         ["step", "zeros", "ones"])


def learn(found: DataFrame) -> tuple[Boosted, float]:
    """Trees and threshold from all counted examples."""
    model = trees.grown(found.where("NOT apart"), len(KINDS), FEATURES)
    steps = (found.where("apart").select("cells", "zeros", "ones")
             .mapInArrow(lambda batches: _steps(batches, model), "step bigint, zeros bigint, ones bigint")
             .groupBy("step").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
             .orderBy(F.desc("step")).collect())  # at most STEPS + 1
    zeros, ones = (np.array([r[k] for r in steps], float) for k in ("zeros", "ones"))
    return model, threshold([r.step / STEPS for r in steps], zeros, ones)


def threshold(scores: list[float], zeros: np.ndarray, ones: np.ndarray) -> float:
    """Of falling scores, with the examples of each label there, the lowest from which on the precision
    is TARGET_PRECISION; 2 if there is none."""
    right = np.cumsum(ones)
    good = np.flatnonzero(right >= TARGET_PRECISION * (right + np.cumsum(zeros)))
    return max(scores[good[-1]], 0.5) if len(good) else 2.0


def searched(text: str) -> tuple[list, list, tuple[list, list]]:
    """Base spans in order, candidates to be judged, and what both come from: the base patterns' matches
    and the loose ones'."""
    found = proposals(text), loose(text)
    base = sorted(((k, a, b) for k, a, b, fits in found[0] if fits),
                  key=lambda s: (s[1], KINDS.index(s[0])))
    return base, found[1] + [(k, a, b) for k, a, b, fits in found[0]
                             if not fits and not _hopeless(k, text[a:b])], found


def accepted(base: list, more: list, score: list[float], least: float) -> list:
    """The candidates that are added to the base spans."""
    ranked = sorted((-s, a, a - b, k, b) for s, (k, a, b) in zip(score, more) if s >= least)
    added, taken = [], Taken((a, b) for _, a, b in base)
    for _, a, _, k, b in ranked:
        if not taken.meets(a, b):
            added.append((k, a, b))
            taken.add(a, b)
    return added


def spans(text: str, model: Boosted, least: float) -> tuple[list, list]:
    """Base spans and added spans (kind, start, end) of a whole text."""
    base, more, _ = searched(text)
    score = model.score(cells([features(text, *c) for c in more]))
    return base, accepted(base, more, score.tolist(), least)


PART = pa.struct([*SPAN, ("base", pa.bool_())])


def _judged(batches, model: Boosted, least: float):
    for batch in batches:
        ids, base, more = batch.columns
        x = trees.matrix(pc.struct_field(more.flatten(), "cells"), FEATURES)
        score, at, out = model.score(x).tolist(), 0, []
        for sure, likely in zip(base.to_pylist(), more.to_pylist()):
            sure = [(s["kind"], s["start"], s["end"]) for s in sure]
            likely = [(s["kind"], s["start"], s["end"]) for s in likely]
            added = accepted(sure, likely, score[at:at + len(likely)], least)
            at += len(likely)
            every = [(*s, True) for s in sure] + [(*s, False) for s in added]
            every.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
            out.append([dict(zip(("kind", "start", "end", "base"), s)) for s in every])
        yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.list_(PART))], ["id", "spans"])


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans array of (kind, start, end, base)) of every row, in code points."""
    rows = scanned(docs, key, text)
    model, least = learn(counted(rows))
    return rows.select("id", "base", "more").mapInArrow(
        lambda batches: _judged(batches, model, least),
        f"id {dict(docs.dtypes)[key]}, "
        "spans array<struct<kind: string, start: bigint, end: bigint, base: boolean>>")


def redacted(text: str, found: list) -> str:
    """The text with each span replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])
