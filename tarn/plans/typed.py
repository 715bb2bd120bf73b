"""From checked documents to typed values, and back to text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions.dates import iso_timestamp, utc_day
from tarn.plans.columns import bind, struct_of, top
from tarn.plans.schema import holds


def _raw_type(dtype: T.DataType) -> str:
    """The type one cast can produce: dates stay text until they are parsed."""
    if isinstance(dtype, T.StructType):
        inner = ",".join("`" + f.name.replace("`", "``") + "`:" + _raw_type(f.dataType) for f in dtype.fields)
        return f"struct<{inner}>"
    if isinstance(dtype, T.ArrayType):
        return f"array<{_raw_type(dtype.elementType)}>"
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return "string"
    return dtype.simpleString()


def _parse_dates(value: Column, dtype: T.DataType) -> Column:
    if not holds(dtype, T.TimestampType, T.DateType):
        return value
    if isinstance(dtype, T.StructType):
        built = struct_of(dtype, [_parse_dates(value.getField(f.name), f.dataType) for f in dtype.fields])
        return F.when(value.isNotNull(), built)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _parse_dates(x, dtype.elementType))
    ts = iso_timestamp(value)
    return utc_day(ts) if isinstance(dtype, T.DateType) else ts


def typed_value(doc: Column, dtype: T.DataType) -> Column:
    """The typed value of a document that passed its rules."""
    return _parse_dates(F.try_variant_get(doc, "$", _raw_type(dtype)), dtype)


def add_typed(df: DataFrame, name: str, doc: Column, dtype: T.DataType) -> DataFrame:
    """The same as a column of a table: the cast runs once per row even when
    dates make the struct be rebuilt."""
    raw = F.try_variant_get(doc, "$", _raw_type(dtype))
    if not holds(dtype, T.TimestampType, T.DateType):
        return df.withColumn(name, raw)
    return bind(df, name, raw).withColumn(name, _parse_dates(top(name), dtype))
