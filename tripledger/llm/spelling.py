"""Spelling variant grouping by a trie of letter-group counts.

Every word becomes a vector: how often each letter group occurs in it. The vectors, group after group
in a fixed order, are the paths of a trie. One inserted letter is a surplus of one in one group, one
replaced letter a surplus of one and a deficit of one, so a depth-first search carries a budget of one
each and leaves a branch as soon as the budget is overdrawn. Of a pair, the word that lacks in the
first differing group searches, so each pair is met once. Leaf words are verified letter by letter.

The trie is cut into a crown and subtrees of at most SUBTREE words (or 1 / CROWN of all words, whatever
is more). The crown holds prefixes only: at most CROWN nodes of a level are larger than a subtree may
be, and each has at most CLIP + 1 children, whatever the data. Tasks search the crown for the subtrees
a word has to visit; a subtree with many visitors is copied for parts of them, and a leaf of more words
than a subtree may hold is dealt out by hash and visited in all parts. Each task reduces what it finds
to one row a word before anything is shuffled again.

Words are counted over all documents with Spark's own functions. Forms have at least FACTOR times the
count of their word, so chains to the root are short; a round a link joins the words whose form was
settled in the round before, and a form has a bounded number of near words, so no key is hot.

Defined results: a null or empty text has no words; a null key counts as empty in the rule that drops
a letter; repeated rows count again, as ties do; a text or a word of any length is taken whole; an
empty table gives an empty result; only the key and the text of a row are read, so further columns
never clash. Counts beyond CLIP letters of a group are cut in the vector alone, which only widens the
search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import text_bytes
from .store import stored

SHORTEST, LEAST = 6, 5
DROP_EVERY = 199
FACTOR = 5
SUBTREE = 16384
CROWN = 8192
VISITORS = 4 * SUBTREE
CLIP = 100
# Letters of a word, and the groups of letters in order of depth, one a letter from the
# most frequent on; the letters beyond a-z share the last groups by their code point's remainder.
LETTERS = "a-z\\u00C0-\\u00FF"
FREQUENT_FIRST = "eianrotslucdmhgpbfvkwzyxjq"
OTHER_GROUPS = 6
GROUPS = len(FREQUENT_FIRST) + OTHER_GROUPS
_GROUP = np.full(256, 0, np.int64)
_GROUP[[ord(c) for c in FREQUENT_FIRST]] = np.arange(len(FREQUENT_FIRST))
_GROUP[0xC0:] = len(FREQUENT_FIRST) + np.arange(64) % OTHER_GROUPS
_NONE = -1  # behind the end of a prefix
_DIRECT = 20_000  # pairs of a node and its searchers compared at once
_WIDE = 48  # words up to this length are verified as arrays


def words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the distinct words of at least SHORTEST letters that occur LEAST times or more."""
    lower = F.translate(F.col(f"`{text}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{SHORTEST},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("id"),
                        F.explode(runs).alias("run"))
    hashed = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    dropped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (found.withColumn("h", hashed)
            .select(F.when(F.col("h") % DROP_EVERY == 0, dropped).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= SHORTEST)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST))


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte a letter, which is its code point, end to end, and where each word begins."""
    data, offsets = text_bytes(column)
    kept = data != 0xC3  # the lead byte of U+00C0 to U+00FF
    places = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kept, out=places[1:])
    flat = data[kept]
    flat[flat >= 0x80] += 0x40
    return flat, places[offsets]


def vectors(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Letter-group counts of each word."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    counts = np.bincount(row * GROUPS + _GROUP[flat], minlength=(len(offsets) - 1) * GROUPS)
    return np.minimum(counts, CLIP).astype(np.int8).reshape(-1, GROUPS)


class Trie:
    """Vectors in order: a node is a range of rows with a common prefix.

    Rows may end early, filled up with _NONE, if no row is the beginning of another.
    """

    def __init__(self, rows: np.ndarray):
        self.order = np.lexsort(rows.T[::-1])
        self.rows = rows[self.order]

    def search(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) pairs whose vectors are within the budget, in parts."""
        rows = self.rows
        start = np.arange(len(queries))
        stack = [(0, len(rows), 0, start, np.zeros(len(queries), np.int8), np.zeros(len(queries), np.int8))]
        while stack:
            low, high, depth, who, surplus, deficit = stack.pop()
            if not len(who) or low == high:
                continue
            if high - low == 1 or (high - low) * len(who) <= _DIRECT:
                for at in range(0, len(who), _DIRECT):
                    query, row = _within(queries[who[at:at + _DIRECT]], rows[low:high])
                    if len(query):
                        yield who[at:at + _DIRECT][query], self.order[low + row]
                continue
            fork = int(np.argmax(rows[low] != rows[high - 1])) if (
                rows[low] != rows[high - 1]).any() else GROUPS
            if fork > depth:
                more = rows[low, depth:fork] - queries[who, depth:fork]
                who, surplus, deficit = _left(
                    who, surplus + np.maximum(more, 0).sum(1), deficit - np.minimum(more, 0).sum(1))
            if fork == GROUPS:  # equal vectors: a leaf
                for at in range(0, len(who), max(1, _DIRECT // (high - low))):
                    part = who[at:at + max(1, _DIRECT // (high - low))]
                    query, row = _within(queries[part], rows[low:high])
                    yield part[query], self.order[low + row]
                continue
            column = rows[low:high, fork]
            edges = np.flatnonzero(np.diff(column)) + 1
            for a, b in zip([0, *edges], [*edges, high - low]):
                more = column[a].astype(np.int64) - queries[who, fork]
                near = np.abs(more) <= 1
                stack.append((low + a, low + b, fork + 1, *_left(
                    who[near], surplus[near] + (more[near] > 0), deficit[near] + (more[near] < 0))))


def _left(who, surplus, deficit):
    """Searchers whose budget holds; a deficit comes after a surplus."""
    ok = (surplus <= 1) & (deficit <= surplus)
    return who[ok], surplus[ok].astype(np.int8), deficit[ok].astype(np.int8)


def _within(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    more = rows[None, :, :] - queries[:, None, :]
    if (rows == _NONE).any():
        more *= (rows != _NONE)[None, :, :]
    query, row = np.nonzero(np.abs(more).sum(2, dtype=np.int64) <= 2)
    more = more[query, row]
    surplus, deficit = np.maximum(more, 0).sum(1), -np.minimum(more, 0).sum(1)
    ordered = (deficit == 0) | ((surplus == 1) & ((more > 0).argmax(1) < (more < 0).argmax(1)))
    ok = (surplus <= 1) & (deficit <= 1) & ordered
    return query[ok], row[ok]


def crown(vocabulary: DataFrame, limit: int) -> np.ndarray:
    """Prefixes of the subtrees: the largest nodes of the trie with at most ``limit`` words, and
    leaves. ``vocabulary`` has the column ``vector``."""
    roots, parents = [], [b""]
    step = 8
    for first in range(0, GROUPS, step):
        depths = range(first, min(first + step, GROUPS))
        under = vocabulary
        if first:
            known = vocabulary.sparkSession.createDataFrame([(p,) for p in parents], "parent binary")
            under = vocabulary.join(F.broadcast(known), F.expr(f"substring(vector, 1, {first})") ==
                                    F.col("parent"), "left_semi")
        nodes = under.select(F.explode(F.array(*[
            F.expr(f"substring(vector, 1, {d + 1})") for d in depths])).alias("prefix")
        ).groupBy("prefix").agg(F.count("*").alias("size"))
        nodes = stored(nodes, "trie-nodes")
        large = {bytes(r.prefix) for r in nodes.where(F.col("size") > limit).select("prefix").collect()}
        inner = {p for p in large if len(p) < GROUPS} | set(parents)
        names = vocabulary.sparkSession.createDataFrame([(p,) for p in inner], "parent binary")
        under_large = nodes.join(F.broadcast(names), F.expr("substring(prefix, 1, length(prefix) - 1)") ==
                                 F.col("parent"), "left_semi")
        roots += [bytes(r.prefix) for r in under_large.where(
            (F.col("size") <= limit) | (F.length("prefix") == GROUPS)).select("prefix").collect()]
        parents = [p for p in large if len(p) == depths[-1] + 1 and len(p) < GROUPS]
        if not parents:
            break
    out = np.full((len(roots), GROUPS), _NONE, np.int8)
    for i, root in enumerate(sorted(roots)):
        out[i, :len(root)] = np.frombuffer(root, np.int8)
    return out


def _with_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = vectors(*letters(batch.column(0)))
        flat = pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(GROUPS), len(found), [None, pa.py_buffer(np.ascontiguousarray(found))])
        yield pa.RecordBatch.from_arrays([*batch.columns, flat.cast(pa.binary())],
                                         ["word", "n", "vector"])


def _visits(batches: Iterator[pa.RecordBatch], roots: np.ndarray) -> Iterator[pa.RecordBatch]:
    trie = Trie(roots)
    for batch in batches:
        for at in range(0, len(batch), 20_000):
            part = batch.slice(at, 20_000)
            own = vectors(*letters(part.column(0)))
            for query, root in trie.search(own):
                home = ((roots[root] == own[query]) | (roots[root] == _NONE)).all(1)
                rows = part.take(pa.array(query))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(root.astype(np.int32)), pa.array(home), rows.column(0), rows.column(1)],
                    ["root", "home", "word", "n"])


def one_apart(flat: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a and b differ by one inserted or replaced letter; b is not the shorter one."""
    size = np.diff(offsets)
    out = np.zeros(len(a), bool)
    fits = (size[b] <= _WIDE) & (size[b] - size[a] <= 1) & (size[b] >= size[a])
    place = np.arange(_WIDE + 1)
    for part in np.array_split(np.flatnonzero(fits), max(1, int(fits.sum()) // 20_000)):
        x, y = (np.where(place < size[w][:, None], flat[np.minimum(
            offsets[w][:, None] + place, len(flat) - 1)], 0) for w in (a[part], b[part]))
        other = x != y
        first = other.argmax(1)
        inserted = size[b[part]] > size[a[part]]
        without = np.where(place[:-1] < first[:, None], y[:, :-1], y[:, 1:])
        out[part] = np.where(inserted, (x[:, :-1] == without).all(1), other.sum(1) == 1)
    for i in np.flatnonzero((size[b] > _WIDE) & (size[b] - size[a] <= 1) & (size[b] >= size[a])):
        x, y = flat[offsets[a[i]]:offsets[a[i] + 1]], flat[offsets[b[i]]:offsets[b[i] + 1]]
        other = np.flatnonzero(x != y[:len(x)])
        first = int(other[0]) if len(other) else len(x)
        out[i] = (np.array_equal(x[first:], y[first + 1:]) if len(y) > len(x)
                  else len(other) == 1)
    return out


PARTIAL = "word string, n bigint, n_near bigint, near_n bigint, near string"


def _near(table: pa.Table) -> pa.Table:
    """What the searchers and the words of a subtree are to each other: one row a word with a near
    one, with the number of its near words here and the best of them."""
    table = table.combine_chunks()
    column, n = table["word"].combine_chunks(), table["n"].to_numpy()
    home = table["home"].to_numpy(zero_copy_only=False)
    flat, offsets = letters(column)
    count = vectors(flat, offsets)
    here, query = np.flatnonzero(home), np.flatnonzero(~home)
    size = np.diff(offsets)
    empty = np.zeros(0, np.int64)
    found: list[np.ndarray] = [empty]
    others: list[np.ndarray] = [empty]
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def verify():
        a, b = (np.concatenate([w[k] for w in waiting]) for k in (0, 1))
        swap = size[a] > size[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        ok = one_apart(flat, offsets, a, b)
        found.append(a[ok])
        others.append(b[ok])
        waiting.clear()

    if len(here) and len(query):
        names = column.to_numpy(zero_copy_only=False)
        for q, r in Trie(count[here]).search(count[query]):
            a, b = query[q], here[r]
            # Words of one vector meet twice: the smaller one searches.
            same = (count[a] == count[b]).all(1)
            keep = ~same
            keep[same] = names[a[same]] < names[b[same]]
            waiting.append((a[keep], b[keep]))
            if sum(len(w[0]) for w in waiting) > 200_000:
                verify()
        if waiting:
            verify()
    a, b = np.concatenate(found), np.concatenate(others)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    if not len(a):
        return pa.table({c: pa.array([], k) for c, k in (
            ("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()),
            ("near_n", pa.int64()), ("near", pa.string()))})
    rank = np.empty(len(column), np.int64)
    rank[pa.compute.array_sort_indices(column.cast(pa.large_binary())).to_numpy()] = np.arange(len(column))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    total = np.diff(np.append(first, len(a)))
    return pa.table({"word": column.take(pa.array(a[first])), "n": n[a[first]], "n_near": total,
                     "near_n": n[b[first]], "near": column.take(pa.array(b[first]))})


def near_words(vocabulary: DataFrame, subtree: int = SUBTREE, visitors: int = VISITORS) -> DataFrame:
    """(word, n, n_near, near, near_n) of every row of ``vocabulary`` (word, n): the number of near
    words, and the one with the largest n, the smallest word among equals."""
    known = stored(vocabulary.mapInArrow(_with_vectors, "word string, n bigint, vector binary"),
                   "spelling-words")
    limit = max(subtree, -(-known.count() // CROWN))
    roots = crown(known, limit)
    visits = stored(known.select("word", "n").mapInArrow(
        lambda batches: _visits(batches, roots), "root int, home boolean, word string, n bigint"),
        "spelling-visits")
    sizes = visits.groupBy("root").agg(
        F.ceil(F.count_if("home") / limit).cast("int").alias("pieces"),
        F.ceil(F.count("*") / max(visitors, limit)).cast("int").alias("parts"))
    dealt = visits.join(F.broadcast(sizes), "root")

    def numbers(many: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), many - 1))

    def one_of(many: str, seed: int) -> Column:
        return F.pmod(F.xxhash64("word", F.lit(seed)), F.col(many)).cast("int")
    words_here = dealt.where("home").select(
        "root", one_of("pieces", 1).alias("piece"), numbers(F.col("parts")).alias("part"), "home",
        "word", "n")
    searchers = dealt.select(
        "root", numbers(F.col("pieces")).alias("piece"), one_of("parts", 2).alias("part"),
        F.lit(False).alias("home"), "word", "n")
    partial = (words_here.unionByName(searchers).groupBy("root", "piece", "part")
               .applyInArrow(_near, PARTIAL))
    alone = known.select("word", "n", F.lit(0).cast("bigint").alias("n_near"),
                         F.lit(None).cast("bigint").alias("near_n"),
                         F.lit(None).cast("string").alias("near"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near")))
    return (alone.unionByName(partial).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n", "n_near", F.col("best.near").alias("near"),
                (-F.col("best.less")).alias("near_n")))


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row a word; see the contract above."""
    return rooted(near_words(words(docs, key, text)))


def rooted(near: DataFrame) -> DataFrame:
    """Each word with its form, if one is FACTOR times as frequent, and the last form of the chain."""
    has = F.col("near_n") >= F.col("n") * FACTOR
    forms = stored(near.select("word", F.when(has, F.col("near")).alias("form"), "n", "n_near",
                               F.when(has, F.col("near_n")).alias("form_n")), "spelling-forms")
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    settled = forms.where(F.col("form").isNull()).withColumn("root", F.col("word")).select(columns)
    open_ends = forms.where(F.col("form").isNotNull())
    out = settled
    while True:
        last = settled.select(F.col("word").alias("form"), "root")
        settled = stored(open_ends.join(last, "form").select(columns), "spelling-roots")
        if settled.isEmpty():
            return out
        out = out.unionByName(settled)
