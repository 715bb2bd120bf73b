"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column or field name that may hold dots or quotes."""
    return "`" + name.replace("`", "``") + "`"


def top(name: str) -> Column:
    return F.col(quoted(name))


def bind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    A plain ``withColumn`` is copied into every later filter and projection
    that names it, so a costly expression (parsing a document, checking it)
    would run several times per row. The optimizer does not move expressions
    across the one-row explode put on top. The value itself stays in the
    projection below it, where it is compiled.
    """
    kept = [top(c) for c in df.columns if c != name]
    return df.select(*kept, value.alias("_bound")).select(*kept, F.explode(F.array("_bound")).alias(name))


def concat_arrays(parts: Sequence[Column]) -> Column:
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def as_list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def struct_of(dtype: T.StructType, values: Sequence[Column]) -> Column:
    """A struct with the field names of ``dtype``."""
    if not dtype.fields:
        return F.struct()
    return F.struct(*[v.alias(f.name) for f, v in zip(dtype.fields, values)])


def compiled_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Compile a schema into a column once per session. ``build`` takes the schema
    and names; the columns it gives hold names only, so they fit any table.
    For a wide schema, building the column takes longer than planning it."""

    built: dict[tuple, Column] = {}

    @wraps(build)
    def call(dtype: T.DataType, *names: str) -> Column:
        session = SparkContext._active_spark_context.applicationId
        if built and next(iter(built))[0] != session:
            built.clear()  # columns of a session that was stopped
        key = (session, dtype.json(), *names)
        if key not in built:
            built[key] = build(dtype, *names)
        return built[key]

    return call
