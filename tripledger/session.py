"""Session helpers: a local session for tests and the shared scratch folder for written data."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "tripledger") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> None:
    """Session settings the queries rely on.

    Trip times are wall-clock values without a zone. Second differences and hour extraction pass
    through the session zone, and a zone with a daylight-saving gap would shift some of them.

    The JVM never compiles a method of more than 8000 bytes. Judging a row against all rules in
    one generated method is longer, so Spark is told to split such a stage instead of running it
    interpreted, which is several times slower.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go with their end, not when the driver collects its garbage.

    For writes: what is written is read back from its files, and no later job asks for the shuffles.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tripledger-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, under the cluster's checkpoint folder.

    Only a local session without that setting falls back to the machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
