"""A registry of the record shapes met in a table of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.plans.columns import bind, concat_arrays, top
from tarn.plans.rules import child
from tarn.plans.schema import ANY_INDEX, check_schema, escape, holds, is_leaf


def shape_of(doc: Column) -> Column:
    """The shape of a parsed document as text. All forms of a number with a
    fraction get one name; field order does not matter, as VARIANT sorts keys."""
    return F.regexp_replace(F.schema_of_variant(doc), r"(?<=^|: |<)(DECIMAL\(\d+, ?\d+\)|FLOAT)(?=[,>]|$)", "DOUBLE")


def shape_registry(df: DataFrame, key: str, doc: str = "doc") -> DataFrame:
    """Each distinct shape once: ``(fingerprint, shape, n, example)``. Shapes are
    counted before the shuffle, so a common shape costs nothing extra; they are
    grouped by their full text, the fingerprint is only a label."""
    shapes = bind(df.select(top(key).alias("_key"), top(doc).alias("_doc")), "shape", shape_of(F.col("_doc")))
    return (
        shapes.where(F.col("shape").isNotNull())
        .groupBy("shape")
        .agg(F.count("*").alias("n"), F.min("_key").alias("example"))
        .select(F.sha2("shape", 256).alias("fingerprint"), "shape", "n", "example")
    )


def _records(value: Column, dtype: T.DataType, path: str) -> Column:
    """An array of ``(path, shape)`` for the records of one document; array
    items all carry the path of their array."""
    if isinstance(dtype, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        inner = F.flatten(F.transform(items, lambda x: _records(x, dtype.elementType, f"{path}/{ANY_INDEX}")))
        return F.coalesce(inner, F.array().cast("array<struct<path:string,shape:string>>"))
    shown = path.replace(ANY_INDEX, "*")
    own = F.array(F.struct(F.lit(shown).alias("path"), shape_of(value).alias("shape")))
    nested = [
        _records(child(value, f.name), f.dataType, f"{path}/{escape(f.name)}")
        for f in dtype.fields
        if holds(f.dataType, T.StructType)
    ]
    return concat_arrays([own, *nested])


def shape_registry_nested(df: DataFrame, schema: T.DataType | str, key: str, doc: str = "doc") -> DataFrame:
    """The same for the record at each struct of the schema, nested ones too.
    Equal records at different paths share one entry:
    ``(fingerprint, shape, n, n_paths, example_path, example)``."""
    dtype = check_schema(schema)
    if is_leaf(dtype) or not holds(dtype, T.StructType):
        raise ValueError("the schema holds no record")
    rows = bind(df.select(top(key).alias("_key"), top(doc).alias("_doc")), "_records", _records(F.col("_doc"), dtype, ""))
    each = rows.select("_key", F.inline("_records")).where(F.col("shape").startswith("OBJECT<"))
    by_path = each.groupBy("shape", "path").agg(F.count("*").alias("n"), F.min("_key").alias("example"))
    return (
        by_path.groupBy("shape")
        .agg(
            F.sum("n").alias("n"),
            F.count("*").alias("n_paths"),
            F.min("path").alias("example_path"),
            F.min("example").alias("example"),
        )
        .select(F.sha2("shape", 256).alias("fingerprint"), "shape", "n", "n_paths", "example_path", "example")
    )
