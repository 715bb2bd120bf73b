"""Projections between documents, rows, flat columns and the Avro layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions.dates import epoch_millis, from_epoch_millis, utc_day, utc_midnight, zoneless_as_utc
from tarn.plans.columns import concat_arrays, struct_of, top
from tarn.plans.schema import SchemaError, check_schema, escape, holds, is_leaf, same_type, type_name

DATES = (T.TimestampType, T.DateType)

# Fixed value: how a timestamp is written in a document.
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timeZone": "UTC"}


def to_rows(df: DataFrame, schema: T.DataType | str, rec: str = "rec", keep: list[str] = ()) -> DataFrame:
    """Typed values as table rows. The fields of a struct become the columns; a
    scalar or an array at the root becomes the one column ``value``."""
    dtype = check_schema(schema)
    kept = [top(c) for c in keep]
    if isinstance(dtype, T.StructType):
        return df.select(*kept, *[top(rec).getField(f.name).alias(f.name) for f in dtype.fields])
    return df.select(*kept, top(rec).alias("value"))


# -- flat columns ----------------------------------------------------------------


def _leaf_columns(value: Column, dtype: T.DataType, names: tuple[str, ...]):
    """``(names from the root, column)`` of each leaf; arrays add no name."""
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _leaf_columns(value.getField(f.name), f.dataType, (*names, f.name))
    elif isinstance(dtype, T.ArrayType) and not is_leaf(dtype.elementType):
        for i, (inner, _) in enumerate(_leaf_columns(value, dtype.elementType, names)):
            yield inner, _leaf_of_items(value, dtype.elementType, names, i)
    else:
        yield names, value


def _leaf_of_items(value: Column, item: T.DataType, names: tuple[str, ...], i: int) -> Column:
    """The i-th leaf of an item, taken from each item."""
    return F.transform(value, lambda x: list(_leaf_columns(x, item, names))[i][1])


def flatten_paths(
    df: DataFrame, schema: T.DataType | str, keep: list[str] = (), separator: str = "_"
) -> DataFrame:
    """One column per leaf, named after its path. Leaves inside arrays stay
    arrays, as an array adds no step to a path."""
    dtype = check_schema(schema)
    if not isinstance(dtype, T.StructType):
        raise SchemaError("only a struct can be flattened into columns")
    columns: list[Column] = [top(c) for c in keep]
    seen = {c.lower() for c in keep}
    for f in dtype.fields:
        for names, column in _leaf_columns(top(f.name), f.dataType, (f.name,)):
            label = separator.join(names)
            if label.lower() in seen:
                raise SchemaError(f"two paths give the column name {label}")
            seen.add(label.lower())
            columns.append(column.alias(label))
    return df.select(*columns)


# -- long form -------------------------------------------------------------------


def _as_text(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return F.date_format(F.to_utc_timestamp(value, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return value.cast("string")


def leaf_entries(value: Column, dtype: T.DataType, path: Column) -> Column:
    """An array of ``(path, type, value)``, one per leaf, with item numbers."""
    if isinstance(dtype, T.ArrayType):
        items = F.transform(
            value,
            lambda x, i: leaf_entries(x, dtype.elementType, F.concat(path, F.lit("/"), i.cast("string"))),
        )
        return F.coalesce(F.flatten(items), F.array().cast("array<struct<path:string,type:string,value:string>>"))
    if isinstance(dtype, T.StructType):
        if not dtype.fields:
            return F.array().cast("array<struct<path:string,type:string,value:string>>")
        return concat_arrays(
            [
                leaf_entries(value.getField(f.name), f.dataType, F.concat(path, F.lit("/" + escape(f.name))))
                for f in dtype.fields
            ]
        )
    entry = F.struct(path.alias("path"), F.lit(type_name(dtype)).alias("type"), _as_text(value, dtype).alias("value"))
    return F.array(entry)


def explode_nodes(df: DataFrame, schema: T.DataType | str, key: str | list[str], rec: str = "rec") -> DataFrame:
    """One row per leaf, ``(key, path, type, value as text)``."""
    dtype = check_schema(schema)
    keys = [top(k) for k in ([key] if isinstance(key, str) else key)]
    leaves = df.select(*keys, leaf_entries(top(rec), dtype, F.lit("")).alias("_leaves"))
    return leaves.select(*keys, F.inline("_leaves"))


# -- Avro layout -----------------------------------------------------------------


def _rebuild(value: Column, dtype: T.DataType, leaf) -> Column:
    """Rebuild a value around its changed leaves; parts holding no date are
    passed on as they are."""
    if not holds(dtype, *DATES):
        return value
    if isinstance(dtype, T.StructType):
        fields = [_rebuild(value.getField(f.name), f.dataType, leaf) for f in dtype.fields]
        return F.when(value.isNotNull(), struct_of(dtype, fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _rebuild(x, dtype.elementType, leaf))
    return leaf(value, dtype)


def _to_millis(value: Column, dtype: T.DataType) -> Column:
    return epoch_millis(utc_midnight(value) if isinstance(dtype, T.DateType) else value)


def _from_millis(value: Column, dtype: T.DataType) -> Column:
    ts = from_epoch_millis(value)
    return utc_day(ts) if isinstance(dtype, T.DateType) else ts


def _each_column(df: DataFrame, schema: T.DataType | str, leaf, keep: list[str]) -> DataFrame:
    dtype = check_schema(schema)
    if not isinstance(dtype, T.StructType):
        raise SchemaError("a table needs a struct schema")
    kept = [top(c) for c in keep]
    return df.select(*kept, *[_rebuild(top(f.name), f.dataType, leaf).alias(f.name) for f in dtype.fields])


def avro_layout(df: DataFrame, schema: T.DataType | str, keep: list[str] = ()) -> DataFrame:
    """The columns of the schema in Avro's physical types: dates and timestamps
    become milliseconds since 1970 (UTC), all else is unchanged."""
    return _each_column(df, schema, _to_millis, keep)


def from_avro_layout(df: DataFrame, schema: T.DataType | str, keep: list[str] = ()) -> DataFrame:
    """The inverse of ``avro_layout``."""
    return _each_column(df, schema, _from_millis, keep)


# -- documents -------------------------------------------------------------------


def to_json_docs(df: DataFrame, schema: T.DataType | str, keep: list[str] = (), name: str = "raw") -> DataFrame:
    """The columns of the schema as one JSON document per row, dates as ISO text."""
    dtype = check_schema(schema)
    if not isinstance(dtype, T.StructType):
        raise SchemaError("a document needs a struct schema")
    doc = F.to_json(F.struct(*[top(f.name) for f in dtype.fields]), {**JSON_TIME, "ignoreNullFields": "false"})
    return df.select(*[top(c) for c in keep], doc.alias(name))


# -- conformance -----------------------------------------------------------------

# The casts between column types that lose nothing.
WIDER = {
    T.ByteType: (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampType,),
    T.TimestampNTZType: (T.TimestampType,),
}


def mismatches(found: T.DataType, wanted: T.DataType, path: str = "") -> list[tuple[str, str, str]]:
    """``(path, expected, found)`` for all that is missing, extra or of another
    type. Decided from the two schemas alone; no data is read."""
    if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
        have = {f.name: f.dataType for f in found.fields}
        issues = []
        for f in wanted.fields:
            step = f"{path}/{escape(f.name)}"
            if f.name in have:
                issues += mismatches(have.pop(f.name), f.dataType, step)
            else:
                issues.append((step, f.dataType.simpleString(), "missing"))
        return issues + [(f"{path}/{escape(n)}", "nothing", t.simpleString()) for n, t in have.items()]
    if isinstance(found, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return mismatches(found.elementType, wanted.elementType, f"{path}/*")
    if same_type(found, wanted) or isinstance(wanted, WIDER.get(type(found), ())):
        return []
    return [(path, wanted.simpleString(), found.simpleString())]


def _conformed(value: Column, found: T.DataType, wanted: T.DataType) -> Column:
    if same_type(found, wanted):
        return value
    if isinstance(wanted, T.StructType):
        have = {f.name: f.dataType for f in found.fields}
        fields = [_conformed(value.getField(f.name), have[f.name], f.dataType) for f in wanted.fields]
        return F.when(value.isNotNull(), struct_of(wanted, fields))
    if isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: _conformed(x, found.elementType, wanted.elementType))
    if isinstance(found, T.DateType):
        return utc_midnight(value)
    if isinstance(found, T.TimestampNTZType):
        return zoneless_as_utc(value)
    return value.cast(wanted)


def conform_table(df: DataFrame, schema: T.DataType | str, allow_extra: bool = False) -> DataFrame:
    """The table under the schema, columns in schema order, or ``SchemaError``
    listing every missing, extra or mistyped column."""
    dtype = check_schema(schema)
    issues = [i for i in mismatches(df.schema, dtype) if not (allow_extra and i[1] == "nothing")]
    if issues:
        raise SchemaError("; ".join(f"{p}: expected {e}, found {f}" for p, e, f in issues))
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_conformed(top(f.name), have[f.name], f.dataType).alias(f.name) for f in dtype.fields])
