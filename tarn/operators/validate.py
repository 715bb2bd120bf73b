"""Validated ingest: every error of every document, good and bad apart.

Operators check documents themselves unless they are told ``checked=True``: then the
``errors`` column is there already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions.pointers import INDEX_STEP
from tarn.plans.columns import as_list, bind, quoted, top
from tarn.plans.rules import add_errors
from tarn.plans.schema import check_schema, holds
from tarn.plans.typed import add_typed


def parse_docs(df: DataFrame, raw: str = "raw", doc: str = "doc") -> DataFrame:
    """Parse a text column into a VARIANT column, once per row. Text that is
    not JSON, or that repeats a key, gives null."""
    return bind(df, doc, F.try_parse_json(top(raw)))


def validate(df: DataFrame, schema: T.DataType | str, doc: str = "doc", errors: str = "errors") -> DataFrame:
    """Add the ``errors`` column: an array of ``(path, code, expected, found)``,
    empty when the document fits the schema. One pass, no shuffle."""
    dtype = check_schema(schema)
    return add_errors(df, doc, dtype, errors)


def decode(
    df: DataFrame,
    schema: T.DataType | str,
    doc: str = "doc",
    rec: str = "rec",
    errors: str = "errors",
    checked: bool = False,
) -> DataFrame:
    """Add ``rec``: the typed value of documents without errors, null for the rest."""
    dtype = check_schema(schema)
    if not checked:
        df = validate(df, dtype, doc, errors)
    return add_typed(df, rec, F.when(F.size(top(errors)) == 0, top(doc)), dtype)


def split_valid(
    df: DataFrame,
    schema: T.DataType | str,
    doc: str = "doc",
    rec: str = "rec",
    errors: str = "errors",
    checked: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Typed good rows, and bad rows with all their errors."""
    dtype = check_schema(schema)
    found = df if checked else validate(df, dtype, doc, errors)
    good = found.where(F.size(top(errors)) == 0).drop(errors)
    good = add_typed(good, rec, top(doc), dtype).drop(doc)
    return good, found.where(F.size(top(errors)) > 0).drop(doc)


def first_incompatibility(
    df: DataFrame, schema: T.DataType | str, key: str, doc: str = "doc", errors: str = "errors", checked: bool = False
) -> DataFrame:
    """For each document that does not fit, its first mismatch in schema order."""
    found = df if checked else validate(df, schema, doc, errors)
    first = found.where(F.size(top(errors)) > 0).select(top(key), top(errors)[0].alias("_first"))
    return first.select(top(key), "_first.path", "_first.expected", "_first.found")


def error_report(
    df: DataFrame,
    schema: T.DataType | str,
    key: str,
    doc: str = "doc",
    errors: str = "errors",
    by: str | list[str] = (),
    checked: bool = False,
) -> DataFrame:
    """What each source must fix: errors counted by path and code, with the
    smallest key as an example. Item numbers in paths are folded into ``*`` so
    that the report grows with the schema, not with the data."""
    found = df if checked else validate(df, schema, doc, errors)
    groups = [quoted(c) for c in as_list(by)]
    each = found.where(F.size(top(errors)) > 0).select(
        *groups, top(key).alias("_key"), F.explode(top(errors)).alias("_error")
    )
    path = F.col("_error.path")
    if holds(check_schema(schema), T.ArrayType):
        path = F.regexp_replace(path, INDEX_STEP, "/*")
    return (
        each.select(*groups, "_key", path.alias("path"), F.col("_error.code").alias("code"))
        .groupBy(*groups, "path", "code")
        .agg(F.count("*").alias("n"), F.min("_key").alias("example"))
    )
