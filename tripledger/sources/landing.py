"""Append-only landing of trip files.

A run writes its rows under its own load id and then one log row per file. Readers see only
logged loads, so a run that dies half-way leaves nothing visible and can simply be repeated. A
file whose content hash is already logged is skipped unless a replay is forced.

Columns are read by the names in each file's header, whatever their order. A file without a source
column is refused and listed; the other files of the delivery land.

A delivery is one folder and is read in one scan. Known files in it are read and dropped, so give
each delivery a folder of its own.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripledger.sources.contract import SOURCE_COLUMNS

LOG_SCHEMA = ("load_id string, source_file string, source_hash string, rows bigint, "
              "ingested_at timestamp_ntz")
REFUSED_SCHEMA = "load_id string, source_file string, source_hash string, missing array<string>"
_CHUNK = 1 << 20
# Schemes that the workers' file reader knows, by Spark's name for them. Files of any other scheme
# are hashed from the bytes Spark itself reads, which holds one file in memory.
STREAMED = {"file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs",
            "abfs": "abfs", "abfss": "abfss"}

# The helpers travel with the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, name, size, time and content of every CSV file; a content not used is not read.

    ``file_path`` is the escaped address that rows carry, ``path`` what a reader is given.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", "true").load(path))
    return files.select(
        F.col("_metadata.file_path").alias("file_path"), "path",
        F.col("_metadata.file_name").alias("source_file"),
        F.col("length").alias("bytes"), F.col("modificationTime").alias("modified_at"), "content")


def address(uri: str) -> str:
    """Spark's address of a file as the workers' file reader spells it."""
    scheme, _, rest = uri.partition(":")
    rest = rest if rest.startswith("//") else f"//{rest}"
    return f"{STREAMED[scheme]}:{rest}"


def _open(uri: str):
    from pyarrow import fs  # on the executor

    filesystem, name = fs.FileSystem.from_uri(address(uri))
    return filesystem.open_input_stream(name)


def _sha256(uri: str) -> str:
    digest = hashlib.sha256()
    with _open(uri) as stream:
        while chunk := stream.read(_CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def _first_line(uri: str) -> str:
    line = b""
    with _open(uri) as stream:
        while b"\n" not in line and (chunk := stream.read(_CHUNK >> 6)):
            line += chunk
    return line.split(b"\n", 1)[0].decode("utf-8-sig", "replace").rstrip("\r")


def _per_file(read: Callable[[str], str], column: str):
    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(**{column: [read(uri) for uri in frame["file_path"]]})
    return batches


def _streamed() -> Column:
    return F.substring_index("file_path", ":", 1).isin(*STREAMED)


def file_hashes(files: DataFrame) -> DataFrame:
    """SHA-256 of each file's bytes.

    One file is one sequential stream by definition of the hash; files are hashed in parallel,
    a megabyte at a time, so a file larger than memory is no problem.
    """
    columns = ["file_path", "path", "source_file", "bytes"]
    near = files.where(_streamed()).select(*columns).mapInPandas(
        _per_file(_sha256, "source_hash"),
        "file_path string, path string, source_file string, bytes bigint, source_hash string")
    return near.unionByName(files.where(~_streamed()).select(
        *columns, F.sha2("content", 256).alias("source_hash")))


# So many files are a broadcast list; beyond, a file's rows meet their header in so many parts.
NEAR_FILES = 10_000
FILE_PARTS = 64


def read_text_rows(spark: SparkSession, path: str, heads: DataFrame,
                   near_files: int = NEAR_FILES) -> DataFrame:
    """Rows of the CSV files below a folder, every source column as text, and the file's path.

    ``heads`` has (file_path, columns) of the files to read. Cells are taken by the name their file
    gives them. The first line of a file is its header; a later line that repeats it is a row.

    Up to NEAR_FILES files are a broadcast list. With more, rows meet the list by their file and a part
    of it, so the blocks of a large file are spread over FILE_PARTS tasks.
    """
    width = heads.agg(F.max(F.size("columns"))).first()[0] or 1
    cells = [f"_c{i}" for i in range(max(width, len(SOURCE_COLUMNS)))]
    # With a schema given, ``header`` does no more than skip the first line of each file.
    rows = (spark.read.option("mode", "PERMISSIVE").option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", "true").option("header", "true")
            .schema(", ".join(f"{c} STRING" for c in cells)).csv(path))
    part = F.pmod(F.xxhash64(F.col("_metadata.file_block_start")), F.lit(FILE_PARTS))
    found = rows.select(F.array(*cells).alias("cells"), F.col("_metadata.file_path").alias("file_path"),
                        part.alias("part"))
    if heads.count() <= near_files:
        named = found.drop("part").join(F.broadcast(heads), "file_path")
    else:
        parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(FILE_PARTS - 1).cast("bigint")))
        named = found.join(heads.withColumn("part", parts), ["file_path", "part"]).drop("part")
    place = {c: F.array_position("columns", c).cast("int") for c in SOURCE_COLUMNS}
    return named.select(
        *[F.when(place[c] > 0, F.try_element_at("cells", place[c])).alias(c)
          for c in SOURCE_COLUMNS],
        *[c for c in named.columns if c not in ("cells", "columns")])


class Landing:
    """Bronze rows and their log under one shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.rows_path = f"{root.rstrip('/')}/bronze_trips"
        self.log_path = f"{root.rstrip('/')}/ingest_log"
        self.refused_path = f"{root.rstrip('/')}/refused_files"

    def log(self) -> DataFrame:
        """One row per landed file and load."""
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def rows(self) -> DataFrame:
        """Rows of logged loads. The filter on the load id prunes unlogged folders."""
        landed = self.spark.read.parquet(self.rows_path)
        return landed.join(self.log().select("load_id").distinct(), "load_id", "left_semi")

    def new_files(self, path: str, force: bool = False) -> DataFrame:
        """Files whose content is not logged; the same content twice is one file."""
        hashes = file_hashes(list_files(self.spark, path))
        first = hashes.groupBy("source_hash").agg(
            F.min(F.struct("file_path", "path", "source_file", "bytes")).alias("file"))
        files = first.select("file.*", "source_hash")
        if force:
            return files
        return files.join(self.log().select("source_hash"), "source_hash", "left_anti")

    def land(self, path: str, force: bool = False) -> str | None:
        """Land the new files of a folder and return the load id, or None without new files."""
        load_id = uuid.uuid4().hex
        staged = f"{self.log_path}_staged/{load_id}"
        new = self.new_files(path, force)
        heads = schema_drift(headers(list_files(self.spark, path)))
        (new.join(heads, "file_path", "left").write.parquet(staged))  # hash every file once
        files = self.spark.read.parquet(staged)
        refused = files.where("profile_status IS NULL OR profile_status = 'FAIL'")
        files = files.where("profile_status <> 'FAIL'")
        if not refused.isEmpty():
            (refused.select(F.lit(load_id).alias("load_id"), "source_file", "source_hash", "missing")
             .write.mode("append").parquet(self.refused_path))
        if files.isEmpty():
            return None
        now = F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
        lineage = files.select("file_path", "columns", "source_file", "source_hash")
        rows = read_text_rows(self.spark, path, lineage).drop("file_path")
        (rows.withColumns({"ingested_at": now, "load_id": F.lit(load_id)})
         .write.mode("append").partitionBy("load_id").parquet(self.rows_path))
        written = (self.spark.read.parquet(f"{self.rows_path}/load_id={load_id}")
                   .groupBy("source_hash").agg(F.count("*").alias("rows")))
        log = files.join(written, "source_hash", "left").select(
            F.lit(load_id).alias("load_id"), "source_file", "source_hash",
            F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), now.alias("ingested_at"))
        log.write.mode("append").parquet(self.log_path)
        return load_id

    def refused(self) -> DataFrame:
        """One row per file that a load refused, with the columns it lacks."""
        try:
            return self.spark.read.schema(REFUSED_SCHEMA).parquet(self.refused_path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], REFUSED_SCHEMA)


def running_totals(log: DataFrame) -> DataFrame:
    """(load_id, rows, at, rows_in_total): one row per load, in order of time and load id.

    A total is that of the days before, whose number is the calendar's, and that of the loads before
    on the same day. Only days are ever ordered in one task, never all loads.
    """
    per_load = log.groupBy("load_id").agg(F.sum("rows").alias("rows"),
                                          F.min("ingested_at").alias("at")).withColumn(
        "day", F.to_date("at"))
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = per_load.groupBy("day").agg(F.sum("rows").alias("on_day")).select(
        F.col("day").alias("of"), F.coalesce(F.sum("on_day").over(earlier), F.lit(0)).alias("before"))
    on_day = Window.partitionBy("day").orderBy("at", "load_id").rowsBetween(Window.unboundedPreceding, 0)
    return (per_load.join(days, F.col("day").eqNullSafe(F.col("of")))
            .select("load_id", "rows", "at",
                    (F.col("before") + F.sum("rows").over(on_day)).alias("rows_in_total")))


def file_profile(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: size, rows, columns, whether the first line names them, encoding and
    compression. Rows and the check of the encoding come from a scan of the folder."""
    files = list_files(spark, path)
    heads = schema_drift(headers(files)).withColumn("header_present",
                                                    F.size(F.array_intersect(
                                                        "columns", F.array(*map(F.lit, SOURCE_COLUMNS))
                                                    )) > 0)
    lines = (spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true")
             .text(path).select("value", F.col("_metadata.file_path").alias("file_path")))
    counted = lines.groupBy("file_path").agg(
        F.count("*").alias("lines"), F.bool_and(F.is_valid_utf8("value")).alias("valid"))
    return (files.select("file_path", "source_file", "bytes").join(heads, "file_path")
            .join(counted, "file_path", "left").select(
                "file_path", "source_file", F.lit("csv").alias("format"), "bytes",
                (F.coalesce("lines", F.lit(0)) - F.col("header_present").cast("bigint")).alias("rows"),
                F.size("columns").cast("bigint").alias("columns"), "header_present",
                F.when(F.coalesce("valid", F.lit(True)), "UTF-8").otherwise("unknown").alias("encoding"),
                F.when(F.lower("source_file").endswith(".gz"), "gzip").otherwise("none")
                .alias("compression")))


def headers(files: DataFrame) -> DataFrame:
    """Column names of each file; only the start of a file is read."""
    lines = files.select("file_path").mapInPandas(_per_file(_first_line, "header"),
                                                  "file_path string, header string")
    names = F.transform(F.split("header", ","), lambda c: F.trim(F.regexp_replace(c, '"', "")))
    return lines.select("file_path", names.alias("columns"))


def schema_drift(found: DataFrame) -> DataFrame:
    """FAIL for a missing source column, WARNING for an extra one or another order, else PASS.

    ``found`` has an array column ``columns`` per file.
    """
    expected = F.array(*[F.lit(c) for c in SOURCE_COLUMNS])
    compared = found.withColumns({
        "missing": F.array_except(expected, F.col("columns")),
        "unexpected": F.array_except(F.col("columns"), expected)})
    in_order = F.array_intersect(F.col("columns"), expected) == expected
    status = (F.when(F.size("missing") > 0, "FAIL")
              .when((F.size("unexpected") > 0) | ~in_order, "WARNING").otherwise("PASS"))
    return compared.withColumns({"in_order": in_order, "profile_status": status})
