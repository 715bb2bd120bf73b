"""Text documents and Parquet tables in, validated tables out."""

from __future__ import annotations

import re

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.operators.validate import decode, parse_docs
from tarn.operators.project import mismatches
from tarn.plans.columns import top
from tarn.plans.schema import SchemaError, check_schema
from tarn.session import delete
from tarn.sources.footers import file_schemas


# Helper columns, under names that no source is likely to use.
_REC, _ERRORS = "_lake_rec", "_lake_errors"


def read_json_docs(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents, one per line, as ``(raw, doc)``. Nothing is assumed about
    them: the text is kept, and ``doc`` is null where it is not JSON."""
    return parse_docs(spark.read.text(path).select(F.col("value").alias("raw")))


def read_parquet_as(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet read under a declared schema. Unsupported types, and declared
    columns that any file lacks or holds in another type, are refused before any
    row is read, with the name of such a file; only the declared columns are scanned.

    Tasks read the footers of all files; the driver meets one file for each schema that differs in declared columns, and
    stops at the first that does not fit. A column may also come from the names of folders."""
    dtype = check_schema(schema)
    if not isinstance(dtype, T.StructType):
        raise SchemaError("a table needs a struct schema")
    whole = spark.read.parquet(path).schema
    for row in file_schemas(spark, path, set(dtype.names)).toLocalIterator():
        example = row["example"]
        held = {f.name: f for f in spark.read.parquet(example).schema.fields}
        held |= {f.name: f for f in whole.fields if f.name not in held and f"/{f.name}=" in example}
        found = T.StructType([held[n] for n in dtype.names if n in held])
        issues = [i for i in mismatches(found, dtype) if i[1] != "nothing"]
        if issues:
            told = "; ".join(f"{p} is {found}, not {wanted}" for p, wanted, found in issues)
            raise SchemaError(f"{row['files']} files do not fit, such as {example}: {told}")
    return spark.read.schema(dtype).parquet(path)


def _storable(dtype: T.DataType) -> None:
    if not isinstance(dtype, T.StructType):
        raise SchemaError("a table needs a struct schema")
    if _has_empty_struct(dtype):
        raise SchemaError("Parquet cannot store an empty struct")
    taken = [f.name for f in dtype.fields if f.name in ("valid", "_raw", "_errors", "_batch")]
    if taken:
        raise SchemaError(f"these names are taken in a lake table: {taken}")


def _has_empty_struct(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_empty_struct(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return not dtype.fields or any(_has_empty_struct(f.dataType) for f in dtype.fields)
    return False


def lake_rows(df: DataFrame, schema: T.DataType | str, keep: list[str] = (), raw: str = "raw") -> DataFrame:
    """Both outcomes in one table: the typed columns, filled for good documents,
    and ``_raw`` and ``_errors``, filled for bad ones; ``valid`` tells which."""
    dtype = check_schema(schema)
    _storable(dtype)
    decoded = decode(df, dtype, rec=_REC, errors=_ERRORS)
    valid = F.size(_ERRORS) == 0
    return decoded.select(
        *[top(c) for c in keep],
        *[F.col(_REC).getField(f.name).alias(f.name) for f in dtype.fields],
        F.when(~valid, top(raw)).alias("_raw"),
        F.when(~valid, F.col(_ERRORS)).alias("_errors"),
        valid.alias("valid"),
    )


def _folder(batch: str) -> str:
    """The name of a batch as it stands in the path."""
    if not re.fullmatch("[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"not a batch name (letters, digits, _ . -): {batch!r}")
    return batch


def write_lake(
    df: DataFrame,
    schema: T.DataType | str,
    path: str,
    quarantine_path: str | None = None,
    keep: list[str] = (),
    mode: str = "errorifexists",
    batch: str | None = None,
) -> None:
    """Store good rows typed, and bad rows aside with all their errors.

    With one path, both go out in a single pass, split by a ``valid`` partition
    column, and nothing is cached. With two paths the checked rows are kept
    (on disk where memory is short) between the two writes.

    With ``batch``, the name of what is loaded (a day, an input file), the rows are added under that name in place of all that
    is stored under it, so a load that is run again, after a failure or by mistake, adds nothing twice. ``mode`` is then not used.
    """
    rows = lake_rows(df, schema, keep)
    if batch is not None:
        _folder(batch)
        rows = rows.withColumn("_batch", F.lit(batch))
    if quarantine_path is None:
        _store(rows, path, ["valid"], mode, batch)
        return
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    named = [] if batch is None else ["_batch"]
    try:
        _store(rows.where("valid").drop("_raw", "_errors", "valid"), path, [], mode, batch)
        _store(rows.where("NOT valid").select(*[top(c) for c in keep], "_raw", "_errors", *named), quarantine_path, [], mode, batch)
    finally:
        rows.unpersist()


def _store(rows: DataFrame, path: str, by: list[str], mode: str, batch: str | None) -> None:
    if batch is None:
        rows.write.mode(mode).partitionBy(*by).parquet(path)
        return
    seen = Observation()
    values = {"valid=true": F.col("valid"), "valid=false": ~F.col("valid")} if by else {"": F.lit(True)}
    counts = [F.count_if(held).alias(part or "all") for part, held in values.items()]
    writer = rows.observe(seen, *counts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("_batch", *by).parquet(path)
    # Parts of an earlier load that got no rows this time are not replaced by the write.
    for part in values:
        if not seen.get[part or "all"]:
            delete(rows.sparkSession, f"{path}/_batch={_folder(batch)}/{part}".rstrip("/"))


def read_lake(spark: SparkSession, path: str, valid: bool = True) -> DataFrame:
    """The good rows of a lake table, or those set aside. Only the files of that
    partition are read."""
    rows = spark.read.parquet(path).where(F.col("valid") == F.lit(valid)).drop("valid", "_batch")
    return rows.drop("_raw", "_errors") if valid else rows
