"""Schemas of all Parquet files of a table, from their footers."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Footers that one task reads.
FILES_PER_TASK = 200

# Fixed value: where Spark keeps the schema of the rows it wrote.
_ROW_SCHEMA = "org.apache.spark.sql.parquet.row.metadata"


def _uri(path: str) -> str:
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def _signature(path: str, names: set[str]) -> str:
    """What a file's footer says of the columns ``names``. Nothing else of the file is read."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(_uri(path))
    with store.open_input_file(place) as file:
        meta = pq.read_metadata(file)
    leaves = (meta.schema.column(i) for i in range(meta.num_columns))
    lines = [f"{c.path} {c.physical_type} {c.logical_type}" for c in leaves if c.path.split(".")[0] in names]
    rows = (meta.metadata or {}).get(_ROW_SCHEMA.encode())
    fields = [f for f in json.loads(rows)["fields"] if f["name"] in names] if rows else []
    return "\n".join([*lines, json.dumps(fields)])


def file_schemas(spark: SparkSession, path: str, names: set[str]) -> DataFrame:
    """One row for each different schema that files at ``path`` have for the columns ``names``: its ``signature``, the number of
    ``files`` and one of them, ``example``. The paths are a table, and tasks read the footers."""
    paths = spark.read.format("binaryFile").load(path).select("path")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"path": frame["path"], "signature": [_signature(p, names) for p in frame["path"]]})

    tasks = -(-paths.count() // FILES_PER_TASK)
    read_all = paths.repartition(max(1, tasks)).mapInPandas(read, "path STRING, signature STRING")
    return read_all.groupBy("signature").agg(F.count("*").alias("files"), F.min("path").alias("example"))
