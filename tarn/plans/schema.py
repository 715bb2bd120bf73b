"""The schema of a source: a Spark type, checked once, walked on the driver.

Everything the library does is compiled from this walk into column
expressions; no record is ever looked at from Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import types as T

# The leaf types of the data model and the names errors use.
LEAF_NAMES = {
    T.BooleanType: "boolean",
    T.DateType: "date",
    T.DoubleType: "double",
    T.FloatType: "float",
    T.IntegerType: "integer",
    T.LongType: "long",
    T.StringType: "string",
    T.TimestampType: "timestamp",
}

# An array item in a schema path. "~" must be followed by 0 or 1 in a JSON
# pointer, so no escaped field name can ever look like this.
ANY_INDEX = "~i"


class SchemaError(ValueError):
    """A schema, or a table, the data model cannot hold."""


def type_name(dtype: T.DataType) -> str:
    if isinstance(dtype, T.StructType):
        return "struct"
    if isinstance(dtype, T.ArrayType):
        return "array"
    return LEAF_NAMES[type(dtype)]


def is_leaf(dtype: T.DataType) -> bool:
    return type(dtype) in LEAF_NAMES


def escape(name: str) -> str:
    """A field name as one step of a JSON pointer (RFC 6901)."""
    return name.replace("~", "~0").replace("/", "~1")


def check_schema(schema: T.DataType | str) -> T.DataType:
    """Return the schema as a Spark type, or raise naming the bad path."""
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    _check(schema, "")
    return schema


def _check(dtype: T.DataType, path: str) -> None:
    where = path or "the root"
    if isinstance(dtype, T.StructType):
        seen: set[str] = set()
        for f in dtype.fields:
            if not f.name:
                raise SchemaError(f"a field without a name under {where}")
            if "'" in f.name and '"' in f.name:
                raise SchemaError(f"a field name holding both kinds of quote under {where}: {f.name}")
            if f.name.lower() in seen:
                raise SchemaError(f"two fields named {f.name} (in any case) under {where}")
            seen.add(f.name.lower())
            _check(f.dataType, f"{path}/{escape(f.name)}")
    elif isinstance(dtype, T.ArrayType):
        _check(dtype.elementType, f"{path}/*")
    elif not is_leaf(dtype):
        raise SchemaError(f"unsupported type {dtype.simpleString()} at {where}")


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal types, whatever their nullability and metadata."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return len(a.fields) == len(b.fields) and all(
            x.name == y.name and same_type(x.dataType, y.dataType) for x, y in zip(a.fields, b.fields)
        )
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return same_type(a.elementType, b.elementType)
    return type(a) is type(b)


def holds(dtype: T.DataType, *kinds: type) -> bool:
    """Is one of these types used anywhere inside?"""
    if isinstance(dtype, kinds):
        return True
    if isinstance(dtype, T.StructType):
        return any(holds(f.dataType, *kinds) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return holds(dtype.elementType, *kinds)
    return False


@dataclass
class Node:
    """One place of a schema. ``id`` numbers nodes from the root down, so the
    nodes below one are exactly ``id + 1 .. end``."""

    id: int
    path: str
    dtype: T.DataType
    name: str | None
    index_steps: tuple[int, ...]  # which steps (from 1) of the path are array indexes
    children: list[Node] = field(default_factory=list)
    end: int = 0

    def walk(self) -> Iterator[Node]:
        yield self
        for child in self.children:
            yield from child.walk()


def node_tree(schema: T.DataType) -> Node:
    """Number the nodes of a checked schema."""
    count = 0

    def build(dtype: T.DataType, path: str, depth: int, steps: tuple[int, ...], name: str | None) -> Node:
        nonlocal count
        node = Node(count, path, dtype, name, steps)
        count += 1
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                node.children.append(build(f.dataType, f"{path}/{escape(f.name)}", depth + 1, steps, f.name))
        elif isinstance(dtype, T.ArrayType):
            node.children.append(
                build(dtype.elementType, f"{path}/{ANY_INDEX}", depth + 1, (*steps, depth + 1), None)
            )
        node.end = count - 1
        return node

    return build(schema, "", 0, (), None)
