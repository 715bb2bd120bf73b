"""Validation rules, compiled from a schema into one column.

One cast spreads a document into a struct whose leaves are still untyped. The
rule of each leaf runs on that struct, giving one small array of booleans. Only
for documents with a false in it are the failed nodes listed, and only listed
nodes are looked at again to say what is wrong. So a good document costs one
compiled test per leaf. The steps are separate projections on purpose: anything
used as the input of a higher-order function is interpreted, not compiled.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count, groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions.dates import iso_timestamp
from tarn.plans.columns import bind, compiled_once, concat_arrays, top
from tarn.plans.schema import escape, is_leaf, type_name

ERROR_TYPE = "array<struct<path:string,code:string,expected:string,found:string>>"

# Bounds of the numeric types.
INT_MIN, INT_MAX = -(2**31), 2**31 - 1
FLOAT_MAX = 3.4028234663852886e38
INFINITY = float("inf")


def no_errors() -> Column:
    return F.array().cast(ERROR_TYPE)


def variant_type(dtype: T.DataType) -> str:
    """The schema with every leaf left untyped: one cast to it fetches all the
    nodes of a document in a single pass."""
    if isinstance(dtype, T.StructType):
        inner = ",".join("`" + f.name.replace("`", "``") + "`:" + variant_type(f.dataType) for f in dtype.fields)
        return f"struct<{inner}>"
    if isinstance(dtype, T.ArrayType):
        return f"array<{variant_type(dtype.elementType)}>"
    return "variant"


def spread_out(doc: Column, dtype: T.DataType) -> Column:
    return doc if is_leaf(dtype) else F.try_variant_get(doc, "$", variant_type(dtype))


# -- leaf rules --------------------------------------------------------------


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _get(v: Column, dtype: str) -> Column:
    return F.try_variant_get(v, "$", dtype)


def is_boolean(v: Column) -> Column:
    return _kind(v) == "BOOLEAN"


def is_string(v: Column) -> Column:
    return _kind(v) == "STRING"


def is_long(v: Column) -> Column:
    return _kind(v) == "BIGINT"


def is_integer(v: Column) -> Column:
    return (_kind(v) == "BIGINT") & _get(v, "bigint").between(INT_MIN, INT_MAX)


def is_number(v: Column) -> Column:
    # The names are BIGINT, DECIMAL(p,s), DOUBLE and FLOAT.
    return F.substring(_kind(v), 1, 5).isin("BIGIN", "DECIM", "DOUBL", "FLOAT")


def is_double(v: Column) -> Column:
    return is_number(v) & (F.abs(_get(v, "double")) < INFINITY)


def is_float(v: Column) -> Column:
    return is_number(v) & (F.abs(_get(v, "double")) <= FLOAT_MAX)


def is_iso_date(v: Column) -> Column:
    return (_kind(v) == "STRING") & iso_timestamp(_get(v, "string")).isNotNull()


LEAF_RULES = {
    T.BooleanType: is_boolean,
    T.DateType: is_iso_date,
    T.DoubleType: is_double,
    T.FloatType: is_float,
    T.IntegerType: is_integer,
    T.LongType: is_long,
    T.StringType: is_string,
    T.TimestampType: is_iso_date,
}


def passes(nodes: Column, dtype: T.DataType) -> Column:
    """True if a spread-out value fits; false or null if not."""
    oks = checks(nodes, dtype)
    return oks[0] if len(oks) == 1 else F.least(*oks)


def checks(nodes: Column, dtype: T.DataType) -> list[Column]:
    """One boolean per leaf, array and empty struct, in schema order. Those of a
    leaf whose parent is missing are false."""
    if isinstance(dtype, T.StructType) and dtype.fields:
        return [ok for f in dtype.fields for ok in checks(nodes.getField(f.name), f.dataType)]
    if isinstance(dtype, T.StructType):
        return [nodes.isNotNull()]
    if isinstance(dtype, T.ArrayType):
        ok = nodes.isNotNull() & F.forall(nodes, lambda x: passes(x, dtype.elementType))
        return [F.coalesce(ok, F.lit(False))]
    return [F.coalesce(LEAF_RULES[type(dtype)](nodes), F.lit(False))]


# -- every error of a document -------------------------------------------------

FAILED_TYPE = "struct<path:string,expected:string,v:variant>"


def child(v: Column, name: str) -> Column:
    """A field of a document as a variant, null if it has none."""
    quote = "'" if "'" not in name else '"'
    return F.try_variant_get(v, f"$[{quote}{name}{quote}]", "variant")


def _failed(path: Column, dtype: T.DataType, v: Column) -> Column:
    return F.struct(path.alias("path"), F.lit(type_name(dtype)).alias("expected"), v.alias("v"))


def failed_nodes(
    nodes: Column, raw: Column, dtype: T.DataType, path: Column, next_ok: Callable[[Column, T.DataType], Column]
) -> Column:
    """The nodes that break a rule, in schema order, in an array that also
    holds nulls for those that do not. ``raw`` is the value itself, read only
    where the spread-out one is null: nothing is listed below a node that is not
    the object or array it should be. ``next_ok`` gives the outcome of the next
    check, in the order of ``checks``."""
    own = _failed(path, dtype, raw)
    if isinstance(dtype, T.ArrayType):
        item = dtype.elementType

        def item_failures(x: Column, i: Column) -> Column:
            items = F.try_variant_get(raw, "$", "array<variant>")
            step = F.concat(path, F.lit("/"), i.cast("string"))
            return failed_nodes(x, F.get(items, i), item, step, check_here)

        ok = next_ok(nodes, dtype)
        return (
            F.when(ok, F.array(F.lit(None).cast(FAILED_TYPE)))
            .when(nodes.isNull(), F.array(own))
            .otherwise(F.flatten(F.transform(nodes, item_failures)))
        )
    if is_leaf(dtype) or not dtype.fields:
        own = own if not is_leaf(dtype) else _failed(path, dtype, nodes)
        return F.array(F.when(~next_ok(nodes, dtype), own))
    parts: list[Column] = []
    for leaves, group in groupby(dtype.fields, lambda f: is_leaf(f.dataType)):
        steps = [(nodes.getField(f.name), f, F.concat(path, F.lit("/" + escape(f.name)))) for f in group]
        if leaves:
            each = [F.when(~next_ok(x, f.dataType), _failed(step, f.dataType, x)) for x, f, step in steps]
            parts.append(F.array(*each))
        else:
            parts.extend(failed_nodes(x, child(raw, f.name), f.dataType, step, next_ok) for x, f, step in steps)
    return F.when(nodes.isNotNull(), concat_arrays(parts)).otherwise(F.array(own))


def check_here(nodes: Column, dtype: T.DataType) -> Column:
    """The outcome of a check worked out on the spot."""
    return checks(nodes, dtype)[0]


def check_at(oks: Column) -> Callable[[Column, T.DataType], Column]:
    """The outcomes of checks that are already in an array column."""
    position = count()
    return lambda nodes, dtype: F.get(oks, F.lit(next(position)))


def _error_code(e: Column, used: set[str]) -> Column:
    """What is wrong with one listed node."""
    v, kind, expected = e.getField("v"), e.getField("kind"), e.getField("expected")
    number = F.substring(kind, 1, 5).isin("BIGIN", "DECIM", "DOUBL", "FLOAT")
    # Whole numbers over 64 bits show up as DECIMAL(p,0) with p of 19 or more.
    too_long = F.regexp_extract(kind, r"^DECIMAL\((\d+),\s*0\)$", 1).try_cast("int") >= 19

    def outcome(right_type: Column, in_range: Column, code: str) -> Column:
        return F.when(~right_type, "type").when(~F.coalesce(in_range, F.lit(False)), code)

    by_type = {
        "boolean": outcome(kind == "BOOLEAN", F.lit(True), "type"),
        "string": outcome(kind == "STRING", F.lit(True), "type"),
        "integer": F.when(F.coalesce(too_long, F.lit(False)), "range").otherwise(
            outcome(kind == "BIGINT", _get(v, "bigint").between(INT_MIN, INT_MAX), "range")
        ),
        "long": F.when(F.coalesce(too_long, F.lit(False)), "range").otherwise(
            outcome(kind == "BIGINT", F.lit(True), "range")
        ),
        "double": outcome(number, F.abs(_get(v, "double")) < INFINITY, "range"),
        "float": outcome(number, F.abs(_get(v, "double")) <= FLOAT_MAX, "range"),
        "timestamp": outcome(kind == "STRING", iso_timestamp(_get(v, "string")).isNotNull(), "date_format"),
        "date": outcome(kind == "STRING", iso_timestamp(_get(v, "string")).isNotNull(), "date_format"),
        "struct": outcome(kind.startswith("OBJECT<"), F.lit(True), "type"),
        "array": outcome(kind.startswith("ARRAY<"), F.lit(True), "type"),
    }
    code = F.when(kind.isNull(), "required").when(kind == "VOID", "null")
    for name in sorted(used):
        code = code.when(expected == name, by_type[name])
    return code


def _names(dtype: T.DataType) -> set[str]:
    if isinstance(dtype, T.StructType):
        return {"struct"}.union(*(_names(f.dataType) for f in dtype.fields))
    if isinstance(dtype, T.ArrayType):
        return {"array"} | _names(dtype.elementType)
    return {type_name(dtype)}


def describe(failed: Column, dtype: T.DataType) -> Column:
    """What is wrong with each listed node: the errors of one document."""
    used = _names(dtype)
    typed = F.transform(
        F.filter(failed, lambda e: e.isNotNull()),
        lambda e: F.struct(
            e.getField("path").alias("path"),
            e.getField("expected").alias("expected"),
            _kind(e.getField("v")).alias("kind"),
            e.getField("v").alias("v"),
        ),
    )
    return F.transform(
        typed,
        lambda e: F.struct(
            e.getField("path").alias("path"),
            _error_code(e, used).alias("code"),
            e.getField("expected").alias("expected"),
            # OBJECT<...>, ARRAY<...> and DECIMAL(p,s) without their details.
            F.coalesce(
                F.substring_index(F.substring_index(e.getField("kind"), "<", 1), "(", 1), F.lit("MISSING")
            ).alias("found"),
        ),
    )


@compiled_once
def _checks_column(dtype: T.DataType) -> Column:
    return F.array(*checks(F.col("_nodes"), dtype))


@compiled_once
def _failed_column(dtype: T.DataType, doc: str) -> Column:
    oks = F.col("_oks")
    listed = failed_nodes(F.col("_nodes"), top(doc), dtype, F.lit(""), check_at(oks))
    return F.when(top(doc).isNotNull() & F.array_contains(oks, False), listed)


@compiled_once
def _errors_column(dtype: T.DataType, doc: str) -> Column:
    malformed = F.array(
        F.struct(
            F.lit("").alias("path"),
            F.lit("malformed").alias("code"),
            F.lit("json").alias("expected"),
            F.lit("TEXT").alias("found"),
        )
    )
    failed = F.col("_failed")
    return (
        F.when(top(doc).isNull(), malformed)
        .when(failed.isNull(), no_errors())
        .otherwise(describe(failed, dtype))
    )


def add_errors(df: DataFrame, doc: str, dtype: T.DataType, name: str) -> DataFrame:
    """Add the errors column: empty for a good document, ``malformed`` for one
    that is not JSON, otherwise all its errors."""
    df = bind(df, "_nodes", spread_out(top(doc), dtype))
    df = bind(df, "_oks", _checks_column(dtype))
    df = bind(df, "_failed", _failed_column(dtype, doc))
    return bind(df.drop("_nodes", "_oks"), name, _errors_column(dtype, doc)).drop("_failed")


def value_failures(value: Column, dtype: T.DataType) -> Column:
    """The failed nodes of a value met inside a larger expression, where
    nothing can be bound first; input for ``describe``."""
    if is_leaf(dtype):
        return F.when(~checks(value, dtype)[0], F.array(_failed(F.lit(""), dtype, value)))
    spread = F.array(spread_out(value, dtype))
    return F.get(F.transform(spread, lambda n: failed_nodes(n, value, dtype, F.lit(""), check_here)), F.lit(0))
