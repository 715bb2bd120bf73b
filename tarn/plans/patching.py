"""Patch rules and setters, compiled from the schema of the entities."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions.pointers import any_index, is_pointer
from tarn.plans.columns import concat_arrays, struct_of
from tarn.plans.rules import FAILED_TYPE, value_failures
from tarn.plans.schema import ANY_INDEX, Node, holds
from tarn.plans.typed import typed_value

LENGTHS_TYPE = "array<struct<inst:string,len:int>>"


def _pattern(path: str) -> str:
    """A regular expression for the concrete paths of a schema path."""
    steps = path.split("/")[1:]
    return "^" + "".join("/" + (r"(0|[1-9][0-9]*)" if s == ANY_INDEX else re.escape(s)) for s in steps) + r"\z"


def path_id(root: Node, path: Column) -> Column:
    """The number of the schema node a path names, null if it names none.

    Number steps become the any-index step, and the result is looked up by
    name. Only below fields whose names are numbers, where that would mistake a
    field for an item, paths are matched one by one.
    """
    nodes = list(root.walk())
    numeric = re.compile(r"/(0|[1-9][0-9]*)(/|$)")
    odd = [n for n in nodes if numeric.search(n.path)]
    plain = {n.path: n.id for n in nodes if n not in odd}
    table = F.create_map(*[F.lit(x) for item in plain.items() for x in item])
    found = F.try_element_at(table, any_index(path))
    for n in odd:
        found = F.when(path.rlike(_pattern(n.path)), F.lit(n.id)).otherwise(found)
    return F.when(is_pointer(path), found)


def _by_id(groups: Sequence[tuple[Sequence[int], Column]], pid: Column, default: Column) -> Column:
    if not groups:
        return default
    result = None
    for ids, value in groups:
        hit = pid.isin(*ids)
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return result.otherwise(default)


def patch_failures(root: Node, pid: Column, value: Column) -> Column:
    """The nodes of a patch value that do not fit the sub-schema its path names.
    Places of the same type share one compiled rule."""
    kinds: dict[str, tuple[T.DataType, list[int]]] = {}
    for n in root.walk():
        kinds.setdefault(n.dtype.json(), (n.dtype, []))[1].append(n.id)
    nothing = F.lit(None).cast(f"array<{FAILED_TYPE}>")
    return _by_id([(ids, value_failures(value, dtype)) for dtype, ids in kinds.values()], pid, nothing)


def index_positions(root: Node, pid: Column) -> Column:
    """Which steps of the path are array indexes (from 1)."""
    groups: dict[tuple[int, ...], list[int]] = {}
    for n in root.walk():
        if n.index_steps:
            groups.setdefault(n.index_steps, []).append(n.id)
    none = F.array().cast("array<int>")
    return _by_id([(ids, F.array(*[F.lit(s) for s in steps])) for steps, ids in groups.items()], pid, none)


def array_depth(root: Node) -> int:
    """How many index steps the deepest path has."""
    return max(len(n.index_steps) for n in root.walk())


def updated(node: Node, current: Column, pid: Column, idx: Column, value: Column) -> Column:
    """``current`` with one node replaced. An index out of range changes nothing.

    The result follows the schema: at each node, either it is the target, or
    the target is below it and its children are rebuilt, or it is kept. Node
    numbers make the second test one range check, so only the parts of the
    schema on the way to the target are walked.
    """
    target = F.when(pid == node.id, typed_value(value, node.dtype))
    if not node.children:
        return target.otherwise(current)
    if isinstance(node.dtype, T.StructType):
        parts = [updated(c, current.getField(c.name), pid, idx, value) for c in node.children]
        below = struct_of(node.dtype, parts)
    else:
        item = node.children[0]
        at = F.get(idx, F.lit(len(item.index_steps) - 1))
        below = F.transform(
            current,
            lambda x, i: F.when(i.cast("bigint") == at, updated(item, x, pid, idx, value)).otherwise(x),
        )
    return target.when((pid > node.id) & (pid <= node.end), below).otherwise(current)


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def all_updated(node: Node, current: Column, patches: Column) -> Column:
    """``current`` after an ordered array of patches ``(seq, path_id, idx, value)``,
    in one walk over the schema instead of one fold step per patch.

    At each node, only its own last patch and the later ones below it count. Under an
    array, items and patches are sorted together by index, so that each item takes
    the run of patches behind it; time grows with items and patches, not with their
    product. Patches past the end of an array change nothing.
    """
    own = F.filter(patches, lambda p: p["path_id"] == node.id)
    changed = F.size(patches) > 0
    if not node.children:
        return F.when(changed, typed_value(F.element_at(own, -1)["value"], node.dtype)).otherwise(current)

    def below(last: Column) -> Column:
        base = F.when(last.isNotNull(), typed_value(last["value"], node.dtype)).otherwise(current)
        later = F.filter(
            patches, lambda p: (p["path_id"] != node.id) & F.coalesce(p["seq"] > last["seq"], F.lit(True))
        )
        return _let(F.struct(base.alias("base"), later.alias("later")), _children)

    def _children(v: Column) -> Column:
        base, later = v["base"], v["later"]
        if isinstance(node.dtype, T.StructType):
            parts = [_child_updated(c, base.getField(c.name), later) for c in node.children]
            return F.when(F.size(later) > 0, struct_of(node.dtype, parts)).otherwise(base)
        return F.when(F.size(later) > 0, _items(node, base, later)).otherwise(base)

    return F.when(changed, _let(F.try_element_at(own, F.lit(-1)), below)).otherwise(current)


def _child_updated(node: Node, current: Column, patches: Column) -> Column:
    """A field after those of the patches that name it or a place below. They are
    picked once: written out at each use, they would triple with every level."""
    own = F.filter(patches, lambda p: p["path_id"].between(node.id, node.end))
    return _let(own, lambda q: all_updated(node, current, q))


def _items(node: Node, items: Column, patches: Column) -> Column:
    """The items of an array after the patches below it."""
    item = node.children[0]
    level = len(item.index_steps) - 1

    def entry(index: Column, order: Column) -> Column:
        return F.struct(index.cast("bigint").alias("index"), order.cast("int").alias("order"))

    # An item is its place with order -1; a patch follows with its own place.
    marks = F.transform(items, lambda x, i: entry(i, F.lit(-1)))
    asked = F.transform(patches, lambda p, k: entry(F.get(p["idx"], F.lit(level)), k))
    asked = F.filter(asked, lambda e: e["index"] < F.size(items))
    merged = F.array_sort(F.concat(marks, asked))

    def placed(m: Column) -> Column:
        spots = F.filter(F.transform(m, lambda e, s: F.when(e["order"] < 0, s)), lambda s: s.isNotNull())
        return _let(F.struct(m.alias("m"), F.concat(spots, F.array(F.size(m))).alias("s")), rebuilt)

    def rebuilt(v: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            start, end = F.get(v["s"], i), F.get(v["s"], i + 1)
            mine = F.slice(v["m"], start + 2, end - start - 1)
            own = F.transform(mine, lambda e: F.get(patches, e["order"]))
            return F.when(end - start > 1, _let(own, lambda q: all_updated(item, x, q))).otherwise(x)

        return F.transform(items, one)

    return _let(merged, placed)


def array_lengths(node: Node, value: Column, path: Column, level: int) -> Column:
    """The lengths of all arrays at or below a typed value whose own path has
    ``level`` index steps, as ``(concrete path, length)``."""
    none = F.array().cast(LENGTHS_TYPE)
    if isinstance(node.dtype, T.ArrayType):
        if len(node.index_steps) == level:
            return F.array(F.struct(path.alias("inst"), F.coalesce(F.size(value), F.lit(0)).alias("len")))
        inner = F.transform(
            value,
            lambda x, i: array_lengths(node.children[0], x, F.concat(path, F.lit("/"), i.cast("string")), level),
        )
        return F.coalesce(F.flatten(inner), none)
    parts = [
        array_lengths(c, value.getField(c.name), F.concat(path, F.lit(c.path[len(node.path) :])), level)
        for c in node.children
        if _reaches(c, level)
    ]
    return concat_arrays(parts) if parts else none


def _reaches(node: Node, level: int) -> bool:
    return any(isinstance(n.dtype, T.ArrayType) and len(n.index_steps) == level for n in node.walk())


def sets_lengths(root: Node, level: int) -> list[int]:
    """The nodes whose replacement sets the length of an array at that level."""
    return [n.id for n in root.walk() if holds(n.dtype, T.ArrayType) and _reaches(n, level)]


def patch_lengths(root: Node, pid: Column, value: Column, path: Column, level: int) -> Column:
    """The array lengths a patch sets."""
    ids = set(sets_lengths(root, level))
    groups = [
        ([n.id], array_lengths(n, typed_value(value, n.dtype), path, level).cast(LENGTHS_TYPE))
        for n in root.walk()
        if n.id in ids
    ]
    return _by_id(groups, pid, F.array().cast(LENGTHS_TYPE))
