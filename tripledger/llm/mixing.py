"""Mixing sources to target weights by Poisson replication.

A source's mean number of repetitions is its target share over its actual share. Each row gets a
uniform number from a hash of its key, its text and the seed, which the Poisson distribution with
that mean turns into a count by inversion: the smallest k whose cumulative probability reaches the
number. The row is written out that often, and the copies are put in the order of another hash,
which is a global shuffle that any engine can repeat.

Target shares: a source's share of the rows to the power TEMPERATURE, normalised, with at most MAX_MEAN
repetitions on average, so a tiny source isn't repeated without end. The limit is part of the target:
what it takes from the small sources is dealt out over the others in proportion, until as many rows are
wanted as there are. The table of cumulative probabilities has so many entries for a source, by the
largest mean, that less than 1e-12 is left beyond. ``shares`` gives each source's target and the share
it reached.

Defined results: a null source is a source of its own; a null key or text takes part in the hash as
an empty string; rows with equal key and text get equal counts; empty and very long texts are rows
like others; an empty table gives an empty result; columns of the input pass through unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import join_counted, stored

TEMPERATURE = 0.7
MAX_MEAN = 4.0
SEED = 7


def uniform(seed: int, *columns: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of the seed and the columns."""
    whole = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit(""))
                                                 for c in columns])
    return F.conv(F.substring(F.md5(whole), 1, 13), 16, 10).cast("bigint") / F.lit(2.0 ** 52)


def most_copies(max_mean: float) -> int:
    """A count that a Poisson number of at most this mean exceeds with a probability below 1e-12."""
    return math.ceil(max_mean + 8 * math.sqrt(max_mean) + 12)


def means(rows: DataFrame, temperature: float, max_mean: float) -> DataFrame:
    """(source, n, mean, target, cumulative): each source's rows, mean number of repetitions, target
    share, and its Poisson distribution function at 0, 1...

    The mean over all rows is one, unless ``max_mean`` is less than that. Sources of equal size share a
    fate, and there are at most as many sizes as the root of twice the rows, which one window orders.
    """
    sizes = stored(rows.groupBy("source").agg(F.count("*").alias("n")), "source-sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    mass = F.pow("n", F.lit(temperature))
    pull = mass / F.col("n")  # a source's mean is this times a factor common to all below the limit
    by_size = sizes.groupBy("n").agg(F.sum("n").alias("rows"), F.sum(mass).alias("mass")).withColumn(
        "pull", pull)
    before = Window.orderBy(F.desc("pull"), "n").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.desc("pull"), "n").rowsBetween(0, Window.unboundedFollowing)
    over = (total - max_mean * F.coalesce(F.sum("rows").over(before), F.lit(0))
            ) / F.sum("mass").over(after) * F.col("pull") > max_mean
    ends = by_size.withColumn("over", over).agg(
        F.coalesce(F.sum(F.when(F.col("over"), F.col("rows"))), F.lit(0)).alias("at_limit"),
        F.sum(F.when(~F.col("over"), F.col("mass"))).alias("mass")).first()
    factor = (total - max_mean * ends.at_limit) / ends.mass if ends.mass else math.inf
    mean = sizes.select("source", "n", F.least(F.lit(factor) * pull, F.lit(max_mean)).alias("mean"))
    wanted = mean.agg(F.sum(F.col("n") * F.col("mean"))).first()[0] or 1.0
    mean = mean.withColumn("target", F.col("n") * F.col("mean") / F.lit(wanted))

    def step(reached: Column, k: Column) -> Column:
        term = reached["term"] * F.col("mean") / k
        return F.struct(term.alias("term"), F.concat(
            reached["sums"], F.array(F.element_at(reached["sums"], -1) + term)).alias("sums"))

    none = F.exp(-F.col("mean"))
    return mean.select("source", "n", "mean", "target", F.aggregate(
        F.sequence(F.lit(1), F.lit(most_copies(max_mean) - 1)),
        F.struct(none.alias("term"), F.array(none).alias("sums")), step,
        lambda reached: reached["sums"]).alias("cumulative"))


def replicated(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
               temperature: float = TEMPERATURE, max_mean: float = MAX_MEAN,
               seed: int = SEED) -> DataFrame:
    """(row, copy, copies, target, place): ``row`` holds the input's columns, ``copy`` counts from 1 to
    ``copies``, ``target`` is the source's target share, and ``place`` is the hash whose order is the
    shuffled order. Rows are dealt out by ``place`` and ordered by it in each partition."""
    spread = _counted(docs, key, text, source, temperature, max_mean, seed).where("copies > 0").select(
        "row", "copies", "target", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    ident = [F.col(f"row.`{key}`"), F.col(f"row.`{text}`")]
    return (spread.withColumn("place", F.md5(F.concat_ws(
                ":", F.lit(f"{seed} place"), "copy",
                *[F.coalesce(c.cast("string"), F.lit("")) for c in ident])))
            .repartition("place").sortWithinPartitions("place"))


def _counted(docs: DataFrame, key: str, text: str, source: str, temperature: float, max_mean: float,
             seed: int) -> DataFrame:
    """(source, row, copies, mean, target) of every row."""
    named = F.col(f"`{source}`").cast("string")
    own = [F.col(f"`{key}`"), F.col(f"`{text}`")]
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), named), F.lit("")).alias("source"),
        uniform(seed, *own).alias("number"), F.struct("*").alias("row"))
    table = stored(means(rows, temperature, max_mean), "mixing")
    total = table.agg(F.sum("n")).first()[0] or 0
    return join_counted(rows, table, "source", "n", total, "inner").select(
        "source", "row", "mean", "target",
        F.size(F.filter("cumulative", lambda p: p <= F.col("number"))).alias("copies"))


def shares(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
           temperature: float = TEMPERATURE, max_mean: float = MAX_MEAN, seed: int = SEED
           ) -> DataFrame:
    """(source, rows, copies, mean, target, reached): one row for each source, null a source of its
    own, with the share of all copies that ``replicated`` is to give it and that it gives it."""
    found = _counted(docs, key, text, source, temperature, max_mean, seed)
    by_source = found.groupBy("source").agg(
        F.count("*").alias("rows"), F.sum("copies").alias("copies"), F.first("mean").alias("mean"),
        F.first("target").alias("target"))
    every = by_source.agg(F.sum("copies")).scalar()
    return by_source.select(
        F.when(F.col("source") != "", F.expr("substring(source, 2)")).alias("source"), "rows", "copies",
        "mean", "target", (F.col("copies") / F.nullif(every, F.lit(0))).alias("reached"))


def mixed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text",
               source: str = "source") -> DataFrame:
    """The replicated rows in shuffled order, with the input's columns alone."""
    return replicated(docs, key, text, source).select("row.*")
