"""Synthetic rows, patches and broken documents, all from hashes of a key.

The same key and seed always give the same value, so a lost task is redone
alike, and nothing but the key is shuffled or kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.operators.project import JSON_TIME
from tarn.plans.columns import as_list, struct_of, top
from tarn.plans.schema import Node, check_schema, escape, is_leaf, node_tree, type_name

# The ranges of generated values.
MICROS_TO_YEAR_9999 = 253_402_300_799_999_999
DAYS_TO_YEAR_9999 = 2_932_896
DOUBLE_MAX = 1.7976931348623157e308
FLOAT_MAX = 3.4028234663852886e38
MAX_DEPTH = 10


def _hash(seed: int, salt: str, *parts: Column) -> Column:
    return F.xxhash64(*parts, F.lit(salt), F.lit(seed))


def _random(dtype: T.DataType, salt: str, seed: int, parts: list[Column], max_items: int) -> Column:
    if isinstance(dtype, T.StructType):
        return struct_of(
            dtype, [_random(f.dataType, f"{salt}/{f.name}", seed, parts, max_items) for f in dtype.fields]
        )
    if isinstance(dtype, T.ArrayType):
        n = F.pmod(_hash(seed, salt + "#", *parts), F.lit(max_items + 1)).cast("int")
        all_items = F.array(*[F.lit(i) for i in range(max_items)])
        return F.transform(
            F.slice(all_items, F.lit(1), n),
            lambda i: _random(dtype.elementType, salt + "/*", seed, [*parts, i], max_items),
        )
    h = _hash(seed, salt, *parts)
    share = h / F.lit(2.0**63)
    if isinstance(dtype, T.BooleanType):
        return (h % 2) == 0
    if isinstance(dtype, T.IntegerType):
        return F.shiftright(h, 32).cast("int")
    if isinstance(dtype, T.LongType):
        return h
    if isinstance(dtype, T.DoubleType):
        return share * F.lit(DOUBLE_MAX)
    if isinstance(dtype, T.FloatType):
        return (share * F.lit(FLOAT_MAX)).cast("float")
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.pmod(h, F.lit(MICROS_TO_YEAR_9999)))
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(F.pmod(h, F.lit(DAYS_TO_YEAR_9999)).cast("int"))
    other = _hash(seed, salt + "'", *parts)
    letters = F.concat(F.conv(F.hex(h), 16, 36), F.lower(F.conv(F.hex(other), 16, 36)))
    return F.substring(letters, F.lit(1), F.pmod(other, F.lit(21)).cast("int"))


def generate_rows(
    ids: DataFrame, schema: T.DataType | str, key: str | list[str] = "id", seed: int = 0, max_items: int = 4
) -> DataFrame:
    """A random row that fits the schema for each key, such as ``spark.range(n)``:
    full ranges of the number types, alphanumeric text, lists of up to
    ``max_items``."""
    dtype = check_schema(schema)
    keys = as_list(key)
    parts = [top(k) for k in keys]
    values = [_random(f.dataType, f.name, seed, parts, max_items).alias(f.name) for f in dtype.fields]
    return ids.select(*parts, *values)


def json_text(value: Column) -> Column:
    """Any typed value as JSON text."""
    wrapped = F.to_json(F.struct(value.alias("v")), {**JSON_TIME, "ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


# -- patches -----------------------------------------------------------------------


def _pick(node: Node, value: Column, path: Column, level: int, depth: Column, seed: int, keys: list[Column]) -> Column:
    """Walk down to a random node that exists in the row, as ``(path, id)``."""
    here = F.struct(path.alias("path"), F.lit(node.id).alias("id"))
    if not node.children or level >= MAX_DEPTH:
        return here
    h = _hash(seed, f"{node.path}?", *keys)
    if isinstance(node.dtype, T.ArrayType):
        at = F.pmod(h, F.size(value).cast("bigint")).cast("int")
        step = F.concat(path, F.lit("/"), at.cast("string"))
        below = _pick(node.children[0], F.get(value, at), step, level + 1, depth, seed, keys)
        return F.when((depth <= level) | (F.coalesce(F.size(value), F.lit(0)) < 1), here).otherwise(below)
    which = F.pmod(h, F.lit(len(node.children)))
    picked = F.when(depth <= level, here)
    for i, c in enumerate(node.children):
        step = F.concat(path, F.lit("/" + escape(c.name)))
        below = _pick(c, value.getField(c.name), step, level + 1, depth, seed, keys)
        picked = picked.when(which == i, below)
    return picked


def generate_patches(
    entities: DataFrame,
    schema: T.DataType | str,
    key: str | list[str],
    n: int = 1,
    seed: int = 0,
    max_items: int = 4,
) -> DataFrame:
    """``n`` random ``replace`` patches per entity as ``(key, nth, path, doc)``: each on
    a node that exists in the entity as it is given, 1 to 10 steps deep, with a value
    that fits. So the first of an entity is never refused, and a later one only where
    an earlier one made an array shorter."""
    root = node_tree(check_schema(schema))
    named = [top(k) for k in as_list(key)]
    entities = entities.withColumn("_nth", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))) if n > 0 else entities.limit(0).withColumn("_nth", F.lit(0))
    keys = [*named, F.col("_nth")]
    row = F.struct(*[top(c.name).alias(c.name) for c in root.children])
    depth = F.pmod(_hash(seed, "depth", *keys), F.lit(MAX_DEPTH)) + 1
    picked = entities.select(*keys, _pick(root, row, F.lit(""), 0, depth, seed, keys).alias("_at"))
    kinds: dict[str, tuple[T.DataType, list[int]]] = {}
    for n in root.walk():
        kinds.setdefault(n.dtype.json(), (n.dtype, []))[1].append(n.id)
    value = None
    for dtype, ids in kinds.values():
        text = json_text(_random(dtype, "patch", seed, keys, max_items))
        hit = F.col("_at.id").isin(ids)
        value = F.when(hit, text) if value is None else value.when(hit, text)
    doc = F.concat(
        F.lit('{"op":"replace","path":'), json_text(F.col("_at.path")), F.lit(',"value":'), value, F.lit("}")
    )
    return picked.select(*named, F.col("_nth").alias("nth"), F.col("_at.path").alias("path"), doc.alias("doc"))


# -- broken documents ----------------------------------------------------------------

# The JSON put in for each fault; "missing" puts nothing.
OUT_OF_RANGE = {"integer": "3000000000", "long": "9223372036854775808", "float": "1e300", "double": "1e400"}
BAD_DATE = '"T10:00"'


def _faults(dtype: T.DataType) -> list[tuple[str, str | None]]:
    """``(error code, JSON put in)`` for the ways to break a field of a type."""
    name = type_name(dtype)
    faults = [("required", None), ("null", "null")]
    faults.append(("type", "1" if name in ("string", "timestamp", "date") else '"x"'))
    if name in OUT_OF_RANGE:
        faults.append(("range", OUT_OF_RANGE[name]))
    if name in ("timestamp", "date"):
        faults.append(("date_format", BAD_DATE))
    return faults


def corrupt_docs(
    df: DataFrame, schema: T.DataType | str, key: str | list[str], rate: float, seed: int = 0
) -> DataFrame:
    """Typed rows as documents ``(key, raw, expected_path, expected_code)``, of
    which about ``rate`` are broken in one place; the last two columns say where and
    how, and are null for the others."""
    dtype = check_schema(schema)
    keys = [top(k) for k in as_list(key)]
    choices: list[tuple[str, str]] = []
    chosen = F.when(
        F.pmod(_hash(seed, "rate", *keys), F.lit(1_000_000)) < F.lit(int(rate * 1_000_000)),
        F.pmod(_hash(seed, "fault", *keys), F.lit(_count_faults(dtype))),
    )

    def field(f: T.StructField, value: Column, path: str) -> Column:
        step = f"{path}/{escape(f.name)}"
        label = F.concat(json_text(F.lit(f.name)), F.lit(":"))
        numbered = []
        for code, text in _faults(f.dataType):
            numbered.append((len(choices), text))
            choices.append((step, code))
        body = render(f.dataType, value, step)
        result = None
        for number, text in numbered:
            broken = F.lit(None).cast("string") if text is None else F.concat(label, F.lit(text))
            hit = F.coalesce(F.col("_fault") == number, F.lit(False))
            result = F.when(hit, broken) if result is None else result.when(hit, broken)
        return result.otherwise(F.concat(label, body))

    def render(t: T.DataType, value: Column, path: str) -> Column:
        if not isinstance(t, T.StructType):
            return json_text(value)
        fields = [field(f, value.getField(f.name) if path else top(f.name), path) for f in t.fields]
        return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))

    raw = render(dtype, F.lit(None), "")
    paths = F.array(*[F.lit(p) for p, _ in choices])
    codes = F.array(*[F.lit(c) for _, c in choices])
    at = F.col("_fault").cast("int")
    return df.withColumn("_fault", chosen).select(
        *keys, raw.alias("raw"), F.get(paths, at).alias("expected_path"), F.get(codes, at).alias("expected_code")
    )


def _count_faults(dtype: T.DataType) -> int:
    if is_leaf(dtype) or isinstance(dtype, T.ArrayType):
        return 0
    return sum(len(_faults(f.dataType)) + _count_faults(f.dataType) for f in dtype.fields)
