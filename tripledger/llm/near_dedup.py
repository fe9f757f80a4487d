"""Near duplicates by an inverted join over MinHash signature coordinates.

A document is the set of its distinct five-word shingles. Documents with the same set are one node.
Each node has a signature of COORDINATES MinHash values and is posted under every pair of coordinate
and value. Two nodes with a similarity of 0.75 agree in 36 of 48 coordinates on average and in
fewer than 20 with a probability below one in a million, so MATCHES is 20.

* Skip: a pair of coordinate and value that only one node has can't make a match. A node with fewer
  than MATCHES shared pairs is out.
* Prefix: of a node's shared pairs, ordered from rare to frequent, the first (number - MATCHES + 1)
  are enough, because two nodes with MATCHES in common have to share one of these.
* Count: candidates get their matches counted over all coordinates, and the full shingle sets of
  those with MATCHES or more are compared exactly.

A posting list of n nodes isn't written out as n^2 pairs. In each round every node of a list is
paired with the list's hub: first the node with the largest share of shingles that others have too,
then the first by a hash. Lists whose nodes are in one component already are finished. After the
rounds, what is left is joined in full: every pair of nodes that share a list and are still in
different components. Sets x and y with a similarity of 0.75 have 3/7 (|x| + |y|) shingles in common
or more, so a pair in which one side has fewer shingles that any other node has is never emitted.
Where both were compared with the same hub h, x and y have no more in common than the smaller of
|x & h| and |y & h| and the smaller of their shared shingles outside h. Both bounds are exact, and
they end the search among many loose copies of one text, most of whose pairs are below the threshold.

Defined results: a null or empty text, or one without words, has an empty set, is linked with
nothing and is its own component; fewer than five words are one shingle; repeated rows are linked,
as their sets are equal; a component is named after its smallest identifier that isn't null; an
empty table gives an empty result; texts are read whole; ``keep_first`` passes all columns through and
bears repeated and null keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import Rolling, blocks, mixed, words
from .components import components
from .store import HOT_SHARE, join_counted, stored

SHINGLE = 5
COORDINATES = 48
MATCHES = 20
PERCENT = 75
HUB_ROUNDS = 1
SALTED = 500  # pairs that share one copy of a hub's set
FILTER_BITS = 1 << 24  # size of the membership filter that spares most documents the second pass

_FACTORS = mixed(np.arange(COORDINATES)) | np.uint64(1)
_SALTS = mixed(np.arange(COORDINATES) + 1_000_003)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row end to end, and each row's first place."""
    found = words(data, offsets, lower=True)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in found.vocabulary.to_pylist()),
                         np.uint64, len(found.vocabulary))
    rolling = Rolling(mixed(hashes[found.codes]) if len(found.codes) else hashes)
    whole = rolling.windows(SHINGLE)
    short = {n: rolling.windows(n) ^ mixed(np.array([n]))[0] for n in range(1, SHINGLE)}
    sets = []
    for a, b in zip(found.first[:-1], found.first[1:]):
        n = b - a
        sets.append(np.unique(whole[a:b - SHINGLE + 1]) if n >= SHINGLE
                    else short[n][a:a + 1] if n else whole[:0])
    sizes = np.array([len(s) for s in sets], np.int64)
    return np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)])


def set_names(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Sixteen bytes that name each row's set: two sums of independent hashes of its members."""
    sums = np.zeros((len(first) - 1, 2), ">u8")
    for k, hashed in enumerate((values, mixed(values ^ np.uint64(0xA5A5A5A5)))):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(hashed, out=total[1:])
        sums[:, k] = total[first[1:]] - total[first[:-1]]
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(16), len(sums), [None, pa.py_buffer(sums.tobytes())]).cast(pa.binary())


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in blocks(batches, "text"):
        values, first = shingle_sets(data, offsets)
        sizes = np.diff(first)
        full = np.flatnonzero(sizes)
        keys = np.zeros((len(full), COORDINATES), np.uint64)
        if len(full):
            for k in range(COORDINATES):
                keys[:, k] = mixed(np.minimum.reduceat(values * _FACTORS[k], first[full])
                                   ^ _SALTS[k])
        ends = np.concatenate([[0], np.cumsum((sizes > 0) * COORDINATES)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(sizes), set_names(values, first),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64)))],
            ["id", "n_shingles", "node", "keys"])


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, n_shingles, node, keys): the set's size, its name and its signature, one row per row."""
    kind = dict(docs.dtypes)[key]
    return (docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(_signatures,
                        f"id {kind}, n_shingles bigint, node binary, keys array<bigint>"))


def shared_keys(nodes: DataFrame) -> DataFrame:
    """(node, keys, prefix): of each node with MATCHES shared pairs or more these pairs from rare to
    frequent, and the prefix of them that any partner has to meet."""
    postings = nodes.select("node", F.explode("keys").alias("key"))
    lists = stored(postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "lists")
    total = nodes.count() * COORDINATES
    met = join_counted(postings, lists, "key", "n", total, "inner")
    ordered = (met.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "key")))
                                       .alias("pairs"))
               .where(F.size("pairs") >= MATCHES))
    return ordered.select(
        "node", F.col("pairs.key").alias("keys"),
        F.slice(F.col("pairs.key"), F.lit(1), F.size("pairs") - (MATCHES - 1)).alias("prefix"))


def _member(name: bytes) -> int:
    return int.from_bytes(name[:8], "big") % FILTER_BITS


def _filter(nodes: DataFrame) -> bytes:
    """A bit for each node, in FILTER_BITS bits whatever the number of nodes."""
    place = F.pmod(F.conv(F.hex(F.substring("node", 1, 8)), 16, 10).cast("decimal(20,0)"),
                   F.lit(FILTER_BITS)).cast("bigint") + 1
    parts = (nodes.select(place.alias("place"))
             .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")))
    width = 4096
    out = bytearray(FILTER_BITS // 8)
    for row in parts.collect():  # at most FILTER_BITS / 32768 rows
        out[(row.bucket - 1) * width:row.bucket * width] = row.bits
    return bytes(out)


def _sets(batches: Iterator[pa.RecordBatch], bits: bytes) -> Iterator[pa.RecordBatch]:
    flags = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
    for _, data, offsets in blocks(batches, "text"):
        values, first = shingle_sets(data, offsets)
        names = set_names(values, first).to_pylist()
        keep = [i for i, name in enumerate(names)
                if first[i + 1] > first[i] and flags[_member(name)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[i] for i in keep], pa.binary()),
             pa.array([values[first[i]:first[i + 1]].view(np.int64) for i in keep],
                      pa.list_(pa.int64()))], ["node", "members"])


def full_sets(docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """(node, members): the full set of each of ``nodes``."""
    return (docs.select(F.col(f"`{text}`").alias("text"))
            .mapInArrow(partial(_sets, bits=_filter(nodes)), "node binary, members array<bigint>")
            .join(nodes.select("node"), "node", "left_semi")
            .groupBy("node").agg(F.first("members").alias("members")))


def _with_side(pairs: DataFrame, side: str, table: DataFrame, column: str,
               hot: DataFrame) -> DataFrame:
    """Add ``column`` of the node named in ``side``. A node that many pairs name has copies, one for
    SALTED pairs, so neither a task nor a broadcast holds more than its share of them."""
    copies = F.coalesce(F.floor(F.col("uses") / SALTED), F.lit(0).cast("bigint"))
    few = F.broadcast(hot.select(F.col("node").alias(side), "uses"))
    dealt = (pairs.join(few, side, "left")
             .withColumn("salt", F.pmod(F.xxhash64("a", "b"), copies + 1)).drop("uses"))
    held = (table.select(F.col("node").alias(side), F.col(column).alias(f"{side}_{column}"))
            .join(few, side, "left")
            .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), copies))).drop("uses"))
    return dealt.join(held, [side, "salt"]).drop("salt")


def compared(pairs: DataFrame, keys: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, linked) of the pairs that agree in MATCHES coordinates, from full sets."""
    uses = (pairs.select(F.explode(F.array("a", "b")).alias("node"))
            .groupBy("node").agg(F.count("*").alias("uses")))
    hot = stored(uses.where((F.col("uses") >= SALTED)
                            & (F.col("uses") * HOT_SHARE >= 2 * pairs.count())), "hot-nodes")
    both = _with_side(_with_side(pairs, "a", keys, "keys", hot), "b", keys, "keys", hot)
    close = both.where(F.size(F.array_intersect("a_keys", "b_keys")) >= MATCHES).select("a", "b")
    full = _with_side(_with_side(close, "a", sets, "members", hot), "b", sets, "members", hot)
    common = F.size(F.array_intersect("a_members", "b_members")).cast("bigint")
    united = F.size("a_members") + F.size("b_members") - F.col("common")
    return (full.select("a", "b", "a_members", "b_members", common.alias("common"))
            .select("a", "b", "common", (100 * F.col("common") >= PERCENT * united).alias("linked")))


def shared_counts(sets: DataFrame) -> DataFrame:
    """(node, size, common): the set's size and how many of its shingles another set has too."""
    members = sets.select("node", F.explode("members").alias("member"))
    uses = members.groupBy("member").agg(F.count("*").alias("n")).where("n > 1")
    total = sets.agg(F.sum(F.size("members"))).first()[0] or 0
    met = join_counted(members, stored(uses, "shared-shingles"), "member", "n", total, "inner")
    return (met.groupBy("node").agg(F.count("*").alias("common"))
            .join(sets.select("node", F.size("members").cast("bigint").alias("size")), "node"))


def _possible(size_a: str, common_a: str, size_b: str, common_b: str) -> Column:
    """No fewer shared shingles on either side than two sets at the threshold have in common."""
    return ((100 + PERCENT) * F.least(F.col(common_a), F.col(common_b))
            >= PERCENT * (F.col(size_a) + F.col(size_b)))


def _open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``lists`` with labels whose list has nodes of more than one component."""
    known = stored(lists.join(labels, "node", "left")
                   .withColumn("label", F.coalesce("label", "node")), "labelled")
    ends = known.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                    F.count("*").alias("n")).where("low <> high")
    return join_counted(known, ends.select("key", "n"), "key", "n", known.count(), "inner")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _hub_pairs(lists: DataFrame, turn: int) -> DataFrame:
    order = (F.col("common") / F.col("size") if turn == 0
             else F.xxhash64("node", F.lit(turn))).alias("order")
    hubs = lists.groupBy("key").agg(
        F.max(F.struct(order, "node", "label", "size", "common")).alias("hub"),
        F.count("*").alias("n"))
    met = join_counted(lists, hubs, "key", "n", lists.count(), "inner")
    return (met.where(F.col("label") != F.col("hub.label"))
            .where(_possible("size", "common", "hub.size", "hub.common"))
            .select(*_pair("node", "hub.node")).distinct())


def references(tested: DataFrame) -> DataFrame:
    """(node, ref, met): for each compared node the partner most nodes were compared with, and the
    number of shingles they have in common."""
    both = tested.select(F.col("a").alias("node"), F.col("b").alias("ref"), "common").unionByName(
        tested.select(F.col("b").alias("node"), F.col("a").alias("ref"), "common"))
    uses = both.groupBy("ref").agg(F.count("*").alias("uses"))
    return (join_counted(both, uses, "ref", "uses", 2 * tested.count(), "inner")
            .groupBy("node").agg(F.max(F.struct("uses", "ref", F.col("common").alias("met")))
                                 .alias("best"))
            .select("node", "best.ref", "best.met"))


def _rest_pairs(lists: DataFrame, tested: DataFrame, keys: DataFrame) -> DataFrame:
    """Every possible pair of nodes that share a list and not a component, less those compared.
    A pair comes from the first list of those it shares."""
    lists = (lists.join(references(tested), "node", "left")
             .withColumn("outside", F.col("common") - F.col("met"))
             .join(keys.select("node", "prefix"), "node"))
    main = (lists.groupBy("key", "label").agg(F.count("*").alias("m"))
            .groupBy("key").agg(F.max(F.struct("m", "label")).alias("main"), F.sum("m").alias("n")))
    whole = stored(join_counted(stored(lists, "rest-lists"), stored(main, "rest-sizes"), "key", "n",
                                lists.count(), "inner").where("main.m < n"), "rest")
    # The nodes off a list's main component are dealt out in parts of SALTED, each with a copy of the list.
    parts = F.floor((F.col("n") - F.col("main.m")) / SALTED) + 1
    minor = (whole.where("label <> main.label")
             .select(F.col("key").alias("x_key"), F.col("main.label").alias("main_label"),
                     F.pmod(F.xxhash64("node"), parts).alias("x_salt"),
                     *[F.col(c).alias(f"x_{c}") for c in lists.columns if c != "key"]))
    copies = whole.select(*lists.columns, F.explode(F.sequence(
        F.lit(0).cast("bigint"), parts - 1)).alias("salt"))
    # A pair off the main component would come up from both sides.
    apart = ((F.col("label") != F.col("x_label"))
             & ((F.col("label") == F.col("main_label")) | (F.col("x_node") < F.col("node"))))
    over_hub = ((100 + PERCENT) * (F.least("met", "x_met") + F.least("outside", "x_outside"))
                >= PERCENT * (F.col("size") + F.col("x_size")))
    bound = F.when(F.col("ref") == F.col("x_ref"), over_hub).otherwise(F.lit(True))
    first = F.element_at(F.array_intersect("x_prefix", "prefix"), 1) == F.col("key")
    pairs = (minor.join(copies, (F.col("x_key") == F.col("key")) & (F.col("x_salt") == F.col("salt")) & apart
                        & _possible("size", "common", "x_size", "x_common") & bound & first)
             .select(*_pair("x_node", "node")))
    return pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")


def linked_nodes(docs: DataFrame, nodes: DataFrame, text: str) -> DataFrame:
    """(node, label): the component of each node that has a link."""
    keys = stored(shared_keys(nodes), "shared-keys")
    sets = stored(full_sets(docs, text, keys), "full-sets")
    able = shared_counts(sets).where(100 * F.col("common") >= PERCENT * F.col("size"))
    lists = stored(keys.join(able, "node")
                   .select("node", "size", "common", F.explode("prefix").alias("key")), "lists")
    spark = docs.sparkSession
    labels = spark.createDataFrame([], "node binary, label binary")
    tested = spark.createDataFrame([], "a binary, b binary, common bigint, linked boolean")
    for turn in range(HUB_ROUNDS + 1):
        still = stored(_open_lists(lists, labels).drop("n"), "open-lists")
        if still.isEmpty():
            break
        pairs = _hub_pairs(still, turn) if turn < HUB_ROUNDS else _rest_pairs(still, tested, keys)
        pairs = stored(pairs, "pairs")
        tested = stored(tested.unionByName(compared(pairs, keys, sets)), "tested")
        labels = stored(components(tested.where("linked").select("a", "b")), "components")
    return labels


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): one row for each input row."""
    signed = stored(signatures(docs, key, text), "signatures")
    rows = signed.select("id", "n_shingles", "node")
    wordy = rows.where("n_shingles > 0")
    info = stored(wordy.groupBy("node").agg(F.min("id").alias("first_id"),
                                            F.count("*").alias("size")), "nodes")
    nodes = signed.where("n_shingles > 0").groupBy("node").agg(F.first("keys").alias("keys"))
    labels = linked_nodes(docs, stored(nodes, "node-keys"), text)
    named = stored(labels.join(info, "node"), "named")
    names = named.groupBy("label").agg(F.min("first_id").alias("component_id"),
                                       F.count("*").alias("nodes"))
    chosen = join_counted(named, names, "label", "nodes", named.count(), "inner")
    sizes = info.join(chosen.select("node", "component_id"), "node", "left").select(
        "node", "size", F.coalesce("component_id", "first_id").alias("component_id"))
    out = join_counted(wordy, sizes, "node", "size", rows.count(), "inner")
    return (out.select("id", "n_shingles", "component_id")
            .unionByName(rows.where("n_shingles = 0")
                         .select("id", "n_shingles", F.col("id").alias("component_id"))))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, all columns as they are: that of the smallest key, a null after all
    others, and among equal keys the first by its place in the stored rows. Rows are told apart by
    place, so different texts under one key are each judged by themselves."""
    rows = stored(docs.select(F.struct("*").alias("row")), "near-rows")
    own = F.col(f"row.`{key}`")
    placed = rows.select(F.struct(
        own.isNull().alias("without"), own.alias("id"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("at")).alias("place"), "row")
    found = classes(placed.select("place", F.col(f"row.`{text}`").alias("text")), "place", "text")
    gone = stored(found.where(F.col("id") != F.col("component_id")).select(
        F.col("id").alias("place")), "gone")
    return placed.join(gone, "place", "left_anti").select("row.*")
