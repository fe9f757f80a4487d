"""Exact deduplication as a stream with disk-backed state, on DataFrame functions only.

The rows are staged as files. A stream reads the files and keeps, by SHA-256 digest of the text, the
number of rows, the largest identifier and the place (file and row) of that row's content, in a
RocksDB state store that never expires a key. Where a digest was hit more than once, the full bytes
of its rows are compared: the smallest and the largest text of the digest have to be the same.
Rows of a digest with different texts are grouped again by the text itself.

Defined results: a null text counts as empty, and empty texts equal each other; a null identifier is
smaller than any other; of rows with equal text and equal identifier one stays, the last by place;
an empty table gives an empty result; texts are compared whole; all columns of the input pass
through ``keep_one`` unchanged, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.session import scratch_dir

from .store import join_counted, settings, stored

# The state is on disk, and a task closes its part when done: an open one holds some MB for itself.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
FILES_PER_BATCH = 2000
# Let Spark filter the texts of rows that were never hit before it deals them out. The filter's size
# is bounded by its own settings, so the size of the groups table need not be.
FILTERED = {
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1000t",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass
class Staged:
    """The rows in the shared folder (digest, id, text, absent, rest) and the state over them."""

    rows: DataFrame
    groups: DataFrame
    total: int


def _named(names: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def _staged(docs: DataFrame, key: str, text: str, digest) -> tuple[DataFrame, str]:
    path = scratch_dir(docs.sparkSession, "dedup-rows")
    given, = _named([text])
    whole = F.coalesce(given, F.lit(""))
    others = [c for c in docs.columns if c != text]
    frame = docs.select(digest(whole).alias("digest"), F.col(f"`{key}`").alias("id"),
                        whole.alias("text"), given.isNull().alias("absent"),
                        F.struct(*_named(others)).alias("rest"))
    frame.write.parquet(path)
    return frame, path


def _placed(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.struct(F.col("id").alias("id"),
                                     F.col("_metadata.file_name").alias("file"),
                                     F.col("_metadata.row_index").alias("row")).alias("place"))


def stream_groups(spark: SparkSession, path: str, schema,
                  files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """(digest, group_size, keep): the state after the stream has read every file below ``path``."""
    log = scratch_dir(spark, "dedup-state")
    rows = _placed(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
                   .parquet(path)).select("digest", "place")
    counted = rows.groupBy("digest").agg(F.count("*").alias("group_size"),
                                         F.max("place").alias("keep"))
    with settings(spark, DISK_STATE):
        query = (counted.writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", log).trigger(availableNow=True).start())
        query.awaitTermination()
        state = spark.read.format("statestore").load(log)
        size, keep = state.schema["value"].dataType.names
        return stored(state.select("key.digest", F.col(f"value.{size}").alias("group_size"),
                                   F.col(f"value.{keep}").alias("keep")), "dedup-groups")


def stage(docs: DataFrame, key: str = "doc_id", text: str = "text", digest=sha256,
          files_per_batch: int = FILES_PER_BATCH) -> Staged:
    """Stage the rows and run the stream over them."""
    spark = docs.sparkSession
    frame, path = _staged(docs, key, text, digest)
    groups = stream_groups(spark, path, frame.schema, files_per_batch)
    rows = _placed(spark.read.schema(frame.schema).parquet(path))
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    return Staged(rows, groups, total)


def _differing(staged: Staged) -> DataFrame:
    """Digests whose rows don't all have the same bytes. The texts of a digest shrink to two in
    each task before they are dealt out, so a hot digest is no load."""
    hit = staged.groups.where("group_size > 1").select("digest", "group_size")
    texts = join_counted(staged.rows.select("digest", "text"), hit, "digest", "group_size",
                         staged.total, "inner")
    return (texts.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
            .where("low <> high").select("digest"))


def _verdicts(staged: Staged, columns: list[str]) -> DataFrame:
    """Every row's chosen columns with group_size, keep_id and kept."""
    need = ["digest", "place", *columns]
    with settings(staged.rows.sparkSession, FILTERED):
        differing = stored(_differing(staged), "dedup-differing")
    rows, groups = staged.rows, staged.groups
    out = []
    if not differing.isEmpty():
        apart = rows.join(differing, "digest")
        regrouped = apart.groupBy("digest", "text").agg(
            F.count("*").alias("group_size"), F.max("place").alias("keep"))
        out.append(apart.join(regrouped, ["digest", "text"]).select(*need, "group_size", "keep"))
        rows = rows.join(differing, "digest", "left_anti")
        groups = groups.join(differing, "digest", "left_anti")
    many = groups.where("group_size > 1")
    out.append(join_counted(rows.select(*need), many, "digest", "group_size", staged.total))
    joined = out[0] if len(out) == 1 else out[0].unionByName(out[1])
    alone = F.col("keep").isNull()
    return joined.select(
        *need, F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.when(alone, F.col("place.id")).otherwise(F.col("keep.id")).alias("keep_id"),
        (alone | F.col("keep").eqNullSafe(F.col("place"))).alias("kept"))


def groups_of_equals(docs: DataFrame, key: str = "doc_id", text: str = "text", digest=sha256,
                     files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """(id, keep_id, group_size, kept, digest): one row for each input row."""
    staged = stage(docs.select(*_named([key, text])), key, text, digest, files_per_batch)
    return _verdicts(staged, []).select(F.col("place.id").alias("id"), "keep_id", "group_size",
                                        "kept", "digest")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", digest=sha256) -> DataFrame:
    """The row with the largest key of each group of equal texts, all columns as they are."""
    kept = _verdicts(stage(docs, key, text, digest), ["rest", "text", "absent"]).where("kept")
    return kept.select(*[
        F.when(~F.col("absent"), F.col("text")).alias(c) if c == text
        else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
