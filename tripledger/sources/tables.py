"""Tables of one layer under a shared folder, replaced as a whole or by partition.

A write is a new folder of Parquet files; what makes it the table is its entry in the table's log, one
small file for each version, named by its number. A number is taken by creating that file, which fails
if it is there, so of two writers that started from the same version one gets an error and no version
is lost. Readers look at the last entry of the one table they ask for.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripledger.session import shuffles_dropped

LATEST = 20  # entries a reader looks back over for one that is finished


class Conflict(RuntimeError):
    """Another writer has committed since this write began: start again from the new version."""


class Store:
    """Frames that read an older version go on reading it; a write that fails leaves the log as it was."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str, version: str) -> str:
        return f"{self.root}/{layer}/{name}/{version}"

    # The log.

    def _file(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def versions(self, layer: str, name: str) -> list[int]:
        """The numbers that are taken, in order."""
        files, folder = self._file(f"{self.root}/_log/{layer}/{name}")
        if not files.exists(folder):
            return []
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json")
                      and not n.startswith("."))

    def _entry(self, layer: str, name: str, number: int) -> dict | None:
        """What a version consists of; None if its writer died over it or is still writing."""
        files, target = self._file(f"{self.root}/_log/{layer}/{name}/{number:012}.json")
        stream = files.open(target)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:
            return None
        finally:
            stream.close()

    def current(self, layer: str, name: str) -> tuple[int, dict | None]:
        """The number last taken and the last finished entry."""
        taken = self.versions(layer, name)
        for number in taken[:-LATEST - 1:-1]:
            if entry := self._entry(layer, name, number):
                return taken[-1], entry
        return (taken[-1] if taken else 0), None

    def commit(self, layer: str, name: str, number: int, entry: dict) -> None:
        """Take a number for an entry, or raise `Conflict`. As safe as the file system's creation of a
        file that must not exist yet."""
        files, target = self._file(f"{self.root}/_log/{layer}/{name}/{number:012}.json")
        try:
            out = files.create(target, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(f"version {number} of {layer}/{name} is taken") from None
            raise
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()

    # Tables.

    def replace(self, layer: str, name: str, rows: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write the whole table and return it as stored, with its real size known to the planner."""
        number, _ = self.current(layer, name)
        version = self._write(layer, name, rows, partition_by)
        parts = {p: version for p in self._folders(layer, name, version, len(partition_by))}
        entry = {"schema": rows.schema.json(), "partition_by": list(partition_by),
                 "version": version, "parts": parts}
        self.commit(layer, name, number + 1, entry)
        return self._table(layer, name, entry)

    def replace_partitions(self, layer: str, name: str, rows: DataFrame) -> DataFrame:
        """Replace the partitions that ``rows`` has, and leave the others of the table as they are."""
        number, before = self.current(layer, name)
        if not _has_files(before) or not before["partition_by"]:
            raise KeyError(f"no partitioned table {layer}/{name} below {self.root}")
        version = self._write(layer, name, rows.select(*json_columns(before["schema"])),
                              before["partition_by"])
        parts = {p: version for p in self._folders(layer, name, version, len(before["partition_by"]))}
        entry = before | {"parts": before["parts"] | parts}
        self.commit(layer, name, number + 1, entry)
        return self._table(layer, name, entry)

    def read(self, layer: str, name: str) -> DataFrame:
        """The current version; also registered as the view ``layer_name`` for SQL. A filter on a
        partition column reads the folders of its values only."""
        _, entry = self.current(layer, name)
        if not _has_files(entry):
            raise KeyError(f"no table {layer}/{name} below {self.root}")
        return self._table(layer, name, entry)

    def drop(self, layer: str, name: str) -> None:
        """Take a table out of the store, and the files of its current version from the disk: frames
        that read it fail from now on. Older versions are left alone. It may be written anew."""
        number, entry = self.current(layer, name)
        if not _has_files(entry):
            raise KeyError(f"no table {layer}/{name} below {self.root}")
        self.commit(layer, name, number + 1, {"dropped": True})
        for version in {entry["version"], *entry["parts"].values()}:
            files, folder = self._file(self.path(layer, name, version))
            files.delete(folder, True)
        self.spark.catalog.dropTempView(f"{layer}_{name}")

    def _table(self, layer: str, name: str, entry: dict) -> DataFrame:
        by_version: dict[str, list[str]] = {}
        for part, version in sorted(entry["parts"].items()):
            by_version.setdefault(version, []).append(part)
        schema = StructType.fromJson(json.loads(entry["schema"]))
        frames = []
        for version, parts in (by_version or {entry["version"]: [""]}).items():
            base = self.path(layer, name, version)
            reader = self.spark.read.schema(schema).option("basePath", base)
            frames.append(reader.parquet(*[f"{base}/{p}".rstrip("/") for p in parts])
                          .select(*schema.names))
        table = reduce(DataFrame.unionByName, frames)
        table.createOrReplaceTempView(f"{layer}_{name}")
        return table

    def _write(self, layer: str, name: str, rows: DataFrame, partition_by: Sequence[str]) -> str:
        version = uuid.uuid4().hex
        writer = rows.write.option("compression", "zstd")
        writer = writer.partitionBy(*partition_by) if partition_by else writer
        with shuffles_dropped(self.spark):
            writer.parquet(self.path(layer, name, version))
        return version

    def _folders(self, layer: str, name: str, version: str, depth: int) -> list[str]:
        """The partition folders of a version, [''] for a table without partitions."""
        files, base = self._file(self.path(layer, name, version))
        found = [""]
        for _ in range(depth):
            found = [f"{p}/{c.getPath().getName()}".lstrip("/") for p in found
                     for c in files.listStatus(self._file(f"{base.toString()}/{p}".rstrip("/"))[1])
                     if c.isDirectory() and "=" in c.getPath().getName()]
        return found


def _has_files(entry: dict | None) -> bool:
    return entry is not None and "dropped" not in entry


def json_columns(schema: str) -> list:
    return [F.col(f["name"]) for f in json.loads(schema)["fields"]]
