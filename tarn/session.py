"""Session defaults, and where durable intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The settings the library's plans count on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Without the call site kept for each column, wide schemas compile faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "tarn", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; on a cluster, leave ``master`` unset."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tarn-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for a table or a stream checkpoint, inside the shared folder
    that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without that setting: it gets a temporary
    folder. On a cluster a machine's own folder would not be seen by the other
    machines, so this raises instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = _local_dir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Each thread has its own, so two streams of one driver never delete each other's tables.
_scope: ContextVar[list[str] | None] = ContextVar("tarn_scope", default=None)

#: Tables of so many bytes, counted as text and 16 more for each row, may be sent to all tasks.
BROADCAST_BYTES = 32 << 20


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def claim(spark: SparkSession, path: str, owner: str) -> bool:
    """Create a file that names its owner; false if one stands there already and names another."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        file = store.create(place, False)
        file.write(bytearray(owner.encode()))
        file.close()
    file = store.open(place)
    try:
        return bytes(file.readAllBytes()).decode() == owner
    finally:
        file.close()


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables staged inside when it ends. For jobs that write
    their result before that; a result that is still to be computed would miss them."""
    mine: list[str] = []
    outer = _scope.set(mine)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in mine:
            delete(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to a work folder and read it back. For results that several
    branches of a plan read: each branch then scans only the rows and columns it
    needs, and a lost executor costs no recomputation."""
    path = work_dir(df.sparkSession, name)
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)



def measured(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``staged``, and how many rows that wrote. The table is marked for broadcast if its size, taken of all rows as they
    were written, is within ``BROADCAST_BYTES``; beyond, joins with it shuffle."""
    seen = Observation()
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(16))
    table = staged(df.observe(seen, F.count("*").alias("rows"), F.sum(width).alias("bytes")), name)
    rows, size = seen.get["rows"], seen.get["bytes"]
    return (F.broadcast(table) if rows and size <= BROADCAST_BYTES else table), rows
