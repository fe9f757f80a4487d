"""How often each trip id occurs, without sending a frequent id to one task.

A first scan reads ids alone and writes the repeated ones with their counts. Repeated ids are the
exception, so their table is mostly small and meets the rows as a broadcast list of at most NEAR_IDS
entries. Beyond that, the ids that are frequent are still few and broadcast; a bitmap of hashed
repeated ids, which partial bitmaps are merged into by OR, tells for most rows that their id is not
repeated; only what is left is joined by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.sources.stages import stored

# An id is frequent when it holds more than 1/100,000 of the rows with a repeated id. Fewer than
# 100,000 ids can satisfy that, whatever the data, so the frequent list is safe to broadcast.
FREQUENT_SHARE = 100_000
# So many repeated ids are a broadcast list; a trip id has some tens of bytes.
NEAR_IDS = 100_000
# Bits of the bitmap of repeated ids: 2**18 rows of 64 bits at most, whatever the data.
BITMAP_BITS = 24


def id_counts(rows: DataFrame) -> DataFrame:
    """(id, n) over rows that have an id; the partial count shrinks a frequent id map-side."""
    return rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.count("*").alias("n"))


def repeated_ids(rows: DataFrame) -> DataFrame:
    """(id, n) of the ids that occur more than once, from one narrow scan, as a stored table."""
    return stored(id_counts(rows).where("n > 1"), "repeated-ids")


def _place() -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(1 << BITMAP_BITS))


def id_bitmap(ids: DataFrame) -> DataFrame:
    """(word, bits): a bitmap over hashed ids in words of 64 bits. Bitmaps of parts of the data are
    merged by OR of equal words."""
    return (ids.select(_place().alias("place")).groupBy(F.shiftright("place", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits")))


def _perhaps(rows: DataFrame, bitmap: DataFrame) -> DataFrame:
    """Rows with an id, with ``perhaps``: whether the bitmap has the id's bit."""
    marked = (rows.withColumn("place", _place()).withColumn("word", F.shiftright("place", 6))
              .join(F.broadcast(bitmap), "word", "left"))
    bit = F.expr("coalesce(shiftrightunsigned(bits, CAST(place & 63 AS INT)) & 1L, 0L) = 1L")
    return marked.select(*rows.columns, bit.alias("perhaps"))


def _divided(repeated: DataFrame, frequent_share: int) -> tuple[DataFrame, DataFrame]:
    """The frequent ids, and the others."""
    total = repeated.agg(F.coalesce(F.sum(F.col("n").cast("decimal(38,0)")), F.lit(0))).first()[0]
    share = F.col("n").cast("decimal(38,0)") * frequent_share
    return (repeated.where(share > F.lit(total).cast("decimal(38,0)")),
            repeated.where(share <= F.lit(total).cast("decimal(38,0)")))


def with_id_occurrences(rows: DataFrame, frequent_share: int = FREQUENT_SHARE,
                        near_ids: int = NEAR_IDS, repeated: DataFrame | None = None) -> DataFrame:
    """Add ``id_occurrences``, the number of rows that share the row's id; NULL without an id.

    With at most ``near_ids`` repeated ids no row is shuffled. Otherwise rows without an id, rows of
    frequent ids and rows whose id the bitmap rules out are not; the rest is joined by id, at the price
    of a second read of ``rows``. ``repeated`` may name a table of `repeated_ids` of these rows.
    """
    repeated = repeated_ids(rows) if repeated is None else repeated
    one = F.lit(1).cast("bigint")
    if repeated.count() <= near_ids:
        joined = rows.join(F.broadcast(repeated), "id", "left")
        return joined.select(*rows.columns, F.when(F.col("id").isNotNull(), F.coalesce("n", one))
                             .alias("id_occurrences"))
    frequent, other = _divided(repeated, frequent_share)
    marked = _perhaps(rows, id_bitmap(repeated))
    near = (marked.where("id IS NULL OR NOT perhaps")
            .withColumn("n", F.when(F.col("id").isNotNull(), one)))
    far = marked.where("id IS NOT NULL AND perhaps")
    hot = far.join(F.broadcast(frequent), "id")
    rest = (far.join(F.broadcast(frequent.select("id")), "id", "left_anti")
            .join(other, "id", "left").withColumn("n", F.coalesce("n", one)))
    joined = near.unionByName(hot).unionByName(rest)
    return joined.select(*rows.columns, F.col("n").alias("id_occurrences"))


def only_once(rows: DataFrame, frequent_share: int = FREQUENT_SHARE, near_ids: int = NEAR_IDS,
              repeated: DataFrame | None = None) -> DataFrame:
    """The rows whose id occurs exactly once, with ``id_occurrences`` 1.

    Rows of repeated ids are dropped by a broadcast list of at most ``near_ids`` ids; with more, the
    rows that the bitmap does not rule out are dealt out by id after the frequent ids are gone.
    """
    repeated = repeated_ids(rows) if repeated is None else repeated
    with_id = rows.where(F.col("id").isNotNull())
    if repeated.count() <= near_ids:
        left = with_id.join(F.broadcast(repeated.select("id")), "id", "left_anti")
    else:
        frequent, other = _divided(repeated, frequent_share)
        marked = _perhaps(with_id, id_bitmap(repeated))
        left = marked.where("NOT perhaps").unionByName(
            marked.where("perhaps").join(F.broadcast(frequent.select("id")), "id", "left_anti")
            .join(other.select("id"), "id", "left_anti"))
    return left.select(*rows.columns, F.lit(1).cast("bigint").alias("id_occurrences"))
