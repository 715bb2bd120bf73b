"""Validate logs of JSON patches and apply them to entities.

No step gathers the log of an entity. A replace patch hides every earlier one on
the same node, so the state of an entity needs only the *latest* patch of
each node; those are found by a partial aggregation before anything is shuffled
by entity, and number no more than the nodes the entity's row can hold. Which
patches were refused on the way is a separate question (an index was in range or
not at that point of the log), answered by an ordered scan that cuts the log of
a busy entity into ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions.pointers import any_index, is_pointer, steps
from tarn.plans.columns import as_list, bind, compiled_once, concat_arrays, quoted, top
from tarn.plans.patching import (
    all_updated,
    array_depth,
    array_lengths,
    index_positions,
    patch_failures,
    patch_lengths,
    path_id,
    sets_lengths,
    updated,
)
from tarn.plans.rules import ERROR_TYPE, checks, child, describe, no_errors
from tarn.plans.schema import Node, SchemaError, check_schema, node_tree
from tarn.plans.typed import typed_value
from tarn.session import measured, staged

REJECT_COLUMNS = ["op", "path", "code", "depth", "errors", "raw"]

# Columns that judging adds to a log, and that attaching adds to entities.
JUDGED = ["op", "path", "value", "raw", "path_id", "depth", "idx", "code", "errors"]
ATTACHED = ["patches", "last_seq"]


def read_patch_log(
    source: DataFrame | str,
    key: str | list[str],
    seq: str,
    doc: str = "doc",
    spark: SparkSession | None = None,
    key_schema: T.StructType | str | None = None,
) -> DataFrame:
    """Patch documents as rows ``(key, seq, op, path, value, raw)``.

    ``source`` is a table with the key, the sequence number and the document
    text, as a message log gives them, or the path of JSON lines holding
    ``key, seq, op, path, value``; ``key_schema`` then gives the types of the keys
    (BIGINT if it does not), and a key or number of another type is null. ``value``
    stays a VARIANT: null where the document has none, a VARIANT null where it says
    null. ``raw`` keeps the text of documents that are not JSON objects.
    """
    keys = as_list(key)
    _refuse([*keys, seq], JUDGED)
    if isinstance(source, str):
        doc = "value"
        parsed = bind(spark.read.text(source), "_doc", F.try_parse_json(doc))
        declared = check_schema(key_schema) if key_schema else T.StructType([])
        types = {f.name: f.dataType for f in declared.fields}
        ids = [_exactly(k, types.get(k, T.LongType())).alias(k) for k in (*keys, seq)]
    else:
        parsed = bind(source, "_doc", F.try_parse_json(top(doc)))
        ids = [top(k) for k in (*keys, seq)]
    is_object = F.coalesce(F.schema_of_variant("_doc").startswith("OBJECT<"), F.lit(False))

    def text(name: str) -> Column:
        v = F.try_variant_get("_doc", f"$.{name}", "variant")
        return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get("_doc", f"$.{name}", "string"))

    return parsed.select(
        *ids,
        text("op").alias("op"),
        text("path").alias("path"),
        F.try_variant_get("_doc", "$.value", "variant").alias("value"),
        F.when(~is_object, F.coalesce(top(doc), F.lit(""))).alias("raw"),
    )


def _refuse(names: list[str], taken: list[str]) -> None:
    bad = [n for n in names if n.lower() in taken]
    if bad:
        raise SchemaError(f"these names are taken: {bad}")


def _exactly(name: str, dtype: T.DataType) -> Column:
    """A field of the document, null where it has another type than declared."""
    value = child(F.col("_doc"), name)
    fits = checks(value, dtype)[0]
    return F.when(value.isNotNull() & fits, typed_value(value, dtype))


def _tree(schema: T.DataType | str) -> Node:
    dtype = check_schema(schema)
    _refuse(dtype.names if isinstance(dtype, T.StructType) else [], ATTACHED)
    return node_tree(dtype)


@compiled_once
def _path_ids(dtype: T.DataType) -> Column:
    return path_id(node_tree(dtype), F.col("path"))


def resolve_paths(patches: DataFrame, schema: T.DataType | str) -> DataFrame:
    """Add ``path_id``, the schema node each path names (null if none), and
    ``depth``, how many of its steps the schema knows."""
    root = _tree(schema)
    resolved = patches.withColumn("path_id", _path_ids(root.dtype))
    known = F.array(*[F.lit(n.path) for n in root.walk()])
    parts = steps(F.col("path"))
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, k), "/")),
    )
    good_prefixes = F.filter(
        prefixes, lambda p: F.array_contains(known, p) | F.array_contains(known, any_index(p))
    )
    depth = (
        F.when(F.col("path_id").isNotNull(), F.size(parts))
        .when(is_pointer(F.col("path")) & (F.size(parts) > 0), F.size(good_prefixes))
        .otherwise(F.lit(0))
    )
    return resolved.withColumn("depth", depth)


@compiled_once
def _value_failures(dtype: T.DataType) -> Column:
    return patch_failures(node_tree(dtype), F.col("path_id"), F.col("value"))


@compiled_once
def _value_errors(dtype: T.DataType) -> Column:
    return describe(F.col("_failed"), dtype)


def validate_patches(patches: DataFrame, schema: T.DataType | str) -> DataFrame:
    """Add ``path_id``, ``idx`` (the numbers in the path), and the verdict that
    needs no entity: ``code`` is null, ``malformed`` (the document is no JSON object),
    ``unsupported_op``, ``invalid_path`` or ``invalid_patch``, with ``errors`` of the
    value under full paths."""
    root = _tree(schema)
    pid = F.col("path_id")
    resolved = resolve_paths(patches, schema)
    positions = index_positions(root, pid)
    numbers = F.transform(
        positions, lambda p: F.coalesce(F.get(steps(F.col("path")), p - 1).try_cast("bigint"), F.lit(2**62))
    )
    missing = F.array(
        F.struct(
            F.lit("").alias("path"), F.lit("required").alias("code"), F.lit("value").alias("expected"),
            F.lit("MISSING").alias("found"),
        )
    ).cast(ERROR_TYPE)
    asks = (F.col("op") == "replace") & pid.isNotNull()
    checked = bind(
        resolved.withColumn("idx", numbers),
        "_failed",
        F.when(asks & F.col("value").isNotNull(), _value_failures(root.dtype)),
    )
    errors = (
        F.when(asks & F.col("value").isNull(), missing)
        .when(F.col("_failed").isNull(), no_errors())
        .otherwise(_value_errors(root.dtype))
    )
    checked = bind(checked, "_errors", errors).drop("_failed")
    full = F.transform(
        "_errors",
        lambda e: F.struct(
            F.concat(F.col("path"), e.getField("path")).alias("path"),
            e.getField("code").alias("code"),
            e.getField("expected").alias("expected"),
            e.getField("found").alias("found"),
        ),
    )
    if "raw" not in checked.columns:
        checked = checked.withColumn("raw", F.lit(None).cast("string"))
    code = (
        F.when(F.col("raw").isNotNull(), "malformed")
        .when(F.col("op").isNull() | (F.col("op") != "replace"), "unsupported_op")
        .when(pid.isNull(), "invalid_path")
        .when(F.size("_errors") > 0, "invalid_patch")
    )
    return checked.withColumn("code", code).withColumn("errors", full).drop("_errors")


def content() -> Column:
    """What a patch says, as a short hash: equal for copies of one message."""
    return F.md5(F.to_json(F.array("op", "path", F.to_json("value"), "raw")))


def judge_log(patches: DataFrame, schema: T.DataType | str, key: str | list[str], seq: str) -> DataFrame:
    """``validate_patches``, and what the log as a whole refuses: a patch without key
    or sequence number is ``no_key`` or ``no_seq``. Equal patches of one entity and number are one message delivered
    again and count once; unequal ones are all ``duplicate_seq``, as their order is unknown.

    The log is parsed and judged once and written to the work folder; the operators
    below read it from several sides. They judge a log themselves unless they are told
    ``judged=True``. Numbers met more than once are found by keys and numbers alone, and only
    their patches are looked at again; the rest of the log is scanned past a broadcast set of
    those numbers, if that is small, and not shuffled."""
    keys = as_list(key)
    _refuse([*keys, seq], JUDGED)
    no_key = F.greatest(*[top(k).isNull() for k in keys], F.lit(False))
    early = F.when(no_key, "no_key").when(top(seq).isNull(), "no_seq").otherwise(F.col("code"))
    once = staged(validate_patches(patches, schema).withColumn("code", early), "judged")
    named = [*keys, seq]
    known = once.where(~no_key & top(seq).isNotNull())
    repeated, n = measured(duplicate_seqs(known, keys, seq).select(*[quoted(c) for c in named]), "repeated")
    if not n:
        return once
    return once.join(repeated, named, "left_anti").unionByName(_settled(known.join(repeated, named, "left_semi"), named))


def _settled(suspects: DataFrame, named: list[str]) -> DataFrame:
    """Of patches that share an entity and a number, one of each content; refused where there are several."""
    others = [c for c in suspects.columns if c not in named]
    each = suspects.groupBy(*[quoted(c) for c in named], content().alias("_content")).agg(
        F.any_value(F.struct(*[top(c).alias(c) for c in others])).alias("_p")
    )
    each = staged(each, "repeated-patches")
    several = each.groupBy(*[quoted(c) for c in named]).agg(F.count("*").alias("_n")).where("_n > 1")
    marked = each.join(several, named, "left")
    code = F.when(F.col("_n").isNotNull(), F.lit("duplicate_seq")).otherwise(F.col("_p.code")).alias("code")
    fields = [code if c == "code" else F.col("_p").getField(c).alias(c) for c in others]
    made = marked.select(*[top(c) for c in named], *fields).select(*[top(c) for c in suspects.columns])
    return staged(made, "settled")


def _accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("code").isNull())


def _checked(patches: DataFrame, schema: T.DataType | str, keys: list[str], seq: str, judged: bool) -> DataFrame:
    return patches if judged else judge_log(patches, schema, keys, seq)


def compact_patch_log(
    patches: DataFrame, schema: T.DataType | str, key: str | list[str], seq: str, judged: bool = False
) -> DataFrame:
    """Keep the latest valid patch of each node of each entity. Applying what is
    kept gives the same entities as the whole log.

    That holds for paths with indexes too. After the last patch that sets an
    array, all its index patches meet the same length, so the latest on an item
    is in range or none is; the ones before are overwritten.

    One aggregation, partial before its shuffle, so a busy entity arrives already reduced and only latest patches are
    sent. It aggregates by sort, as values have no fixed width; a hash aggregation of numbers alone, joined back with the
    """
    keys = as_list(key)
    good = _accepted(_checked(patches, schema, keys, seq, judged))
    latest = F.max_by(F.struct(top(seq).alias("seq"), "path_id", "idx", "value"), top(seq))
    return (
        good.groupBy(*[quoted(k) for k in keys], "path")
        .agg(latest.alias("_p"))
        .select(*[top(k) for k in keys], F.col("_p.seq").alias(seq), "path", "_p.path_id", "_p.idx", "_p.value")
    )


def duplicate_seqs(patches: DataFrame, key: str | list[str], seq: str) -> DataFrame:
    """Sequence numbers used more than once by an entity, which is an error:
    the order of those patches is unknown."""
    keys = [quoted(k) for k in as_list(key)]
    return patches.groupBy(*keys, quoted(seq)).agg(F.count("*").alias("n")).where("n > 1")


# -- array lengths ---------------------------------------------------------------


def _entity_lengths(entities: DataFrame, asked: DataFrame, root: Node, keys: list[str], levels: range) -> DataFrame:
    """The array lengths of the entities that ``asked`` names, as they come: they
    stand before the whole log, or right after ``last_seq`` where the entities carry
    that column. Other entities are left out before their arrays are looked at."""
    named = [quoted(k) for k in keys]
    entities = entities.join(asked.select(*named).distinct(), keys, "left_semi")
    row = F.struct(*[top(c.name).alias(c.name) for c in root.children])
    at = F.col("last_seq") if "last_seq" in entities.columns else F.lit(None)
    lengths = concat_arrays([array_lengths(root, row, F.lit(""), level) for level in levels]).alias("_lengths")
    named = entities.select(*[top(k) for k in keys], at.cast("bigint").alias("_at"), lengths)
    return named.select(*[top(k) for k in keys], "_at", F.lit(True).alias("_base"), F.inline("_lengths"))


def _length_changes(good: DataFrame, root: Node, keys: list[str], seq: str, levels: range) -> DataFrame:
    """The array lengths that patches set."""
    setters = good.where(F.col("path_id").isin(*{n for level in levels for n in sets_lengths(root, level)}))
    lengths = [patch_lengths(root, F.col("path_id"), F.col("value"), F.col("path"), level) for level in levels]
    named = setters.select(*[top(k) for k in keys], top(seq).cast("bigint").alias("_at"), concat_arrays(lengths).alias("_lengths"))
    return named.select(*[top(k) for k in keys], "_at", F.lit(False).alias("_base"), F.inline("_lengths"))


def _array_path(root: Node, level: int) -> Column:
    """The concrete path of the array that the ``level + 1``-th index is for."""
    position = F.get(index_positions(root, F.col("path_id")), F.lit(level))
    parts = F.slice(steps(F.col("path")), F.lit(1), position - 1)
    return F.when(position == 1, F.lit("")).otherwise(F.concat(F.lit("/"), F.array_join(parts, "/")))


def _reachable(entities: DataFrame, latest: DataFrame, root: Node, keys: list[str], seq: str) -> DataFrame:
    """Drop the latest patches whose index no longer exists once the last
    patch on their array is in. What is left fits in the entity, so it may be
    gathered on one row."""
    names = [*[quoted(k) for k in keys], "inst"]
    for level in range(array_depth(root)):
        settled = latest.where(F.size("idx") <= level)
        pending = latest.where(F.size("idx") > level).withColumn("inst", _array_path(root, level))
        start = _entity_lengths(entities, pending, root, keys, range(level, level + 1))
        changes = _length_changes(settled, root, keys, seq, range(level, level + 1))
        lengths = (
            start.unionByName(changes)
            .groupBy(*names)
            .agg(F.max_by(F.struct("len", "_at"), F.struct("_at", "_base")).alias("_l"))
        )
        kept = (
            pending.join(lengths, [*keys, "inst"], "inner")
            .where(F.coalesce(F.col("_l._at") < top(seq), F.lit(True)))
            .where(F.get("idx", F.lit(level)) < F.col("_l.len"))
            .drop("inst", "_l")
        )
        latest = settled.unionByName(kept)
    return latest


# -- state -----------------------------------------------------------------------


def attach_patches(
    entities: DataFrame,
    patches: DataFrame,
    schema: T.DataType | str,
    key: str | list[str],
    seq: str,
    judged: bool = False,
) -> DataFrame:
    """Put on each entity's row the patches that make its new state, in order,
    as ``patches``, with ``last_seq``, the newest of them. The log is compacted on
    the way, so the array is bounded by the size of the entity. Where the
    entities carry ``last_seq`` already, patches up to it are left out."""
    root, keys = _tree(schema), as_list(key)
    latest = compact_patch_log(patches, schema, keys, seq, judged)
    if array_depth(root):
        latest = _reachable(entities, latest, root, keys, seq)
    entry = F.struct(top(seq).alias("seq"), F.col("path"), F.col("path_id"), F.col("idx"), F.col("value"))
    gathered = latest.groupBy(*[quoted(k) for k in keys]).agg(
        F.collect_list(entry).alias("_list"), F.max(top(seq)).alias("_newest")
    )

    def by_seq(a: Column, b: Column) -> Column:
        return F.when(a["seq"] < b["seq"], -1).when(a["seq"] > b["seq"], 1).otherwise(0)

    joined = entities.join(gathered, keys, "left")
    kept, newest = F.col("_list"), F.col("_newest")
    if "last_seq" in entities.columns:
        done = F.coalesce(F.col("last_seq"), F.lit(-(2**63)))
        kept = F.filter("_list", lambda p: p["seq"] > done)
        newest = F.greatest("last_seq", "_newest")
    ordered = joined.withColumn("patches", F.array_sort(kept, by_seq)).withColumn("last_seq", newest)
    others = [c for c in entities.columns if c != "last_seq"]
    return ordered.select(*[top(c) for c in others], "patches", "last_seq")


def apply_patch_log(
    entities: DataFrame,
    patches: DataFrame,
    schema: T.DataType | str,
    key: str | list[str],
    seq: str,
    judged: bool = False,
) -> DataFrame:
    """The entities after the whole log, each patch in order of ``seq``. A
    refused patch changes nothing (``patch_rejects`` lists them) and entities
    without patches stay as they are. ``last_seq`` is added: given again with the
    next log, it makes patches that were applied before, or come late, count for
    nothing."""
    root, keys = _tree(schema), as_list(key)
    attached = attach_patches(entities, patches, schema, keys, seq, judged)
    row = F.struct(*[top(c.name).alias(c.name) for c in root.children])
    folded = all_updated(root, row, F.col("patches"))
    done = bind(attached, "_state", F.when(F.col("patches").isNotNull(), folded).otherwise(row))
    fields = {c.name for c in root.children}
    return done.select(
        *[
            F.col("_state").getField(c).alias(c) if c in fields else top(c)
            for c in entities.columns
            if c != "last_seq"
        ],
        "last_seq",
    )


def apply_patch(entities: DataFrame, path: str, value: str, schema: T.DataType | str, op: str = "replace") -> DataFrame:
    """Apply one patch, given as text, to every entity. ``patch_code`` says why
    an entity was left as it was, null if it was updated."""
    root = _tree(schema)
    spark = entities.sparkSession
    one = spark.range(1).select(
        F.lit(op).alias("op"), F.lit(path).alias("path"), F.try_parse_json(F.lit(value)).alias("value")
    )
    verdict = validate_patches(one, schema).select("code", "path_id", "idx").first()
    if verdict["code"]:
        return entities.withColumn("patch_code", F.lit(verdict["code"]))
    idx = F.array(*[F.lit(i) for i in verdict["idx"]]).cast("array<bigint>")
    pid = F.lit(verdict["path_id"])
    row = F.struct(*[top(c.name).alias(c.name) for c in root.children])
    target = next(n for n in root.walk() if n.id == verdict["path_id"])
    exists = _exists_in(root, row, target, list(verdict["idx"]))
    new = updated(root, row, pid, idx, F.try_parse_json(F.lit(value)))
    done = bind(entities, "_state", new)
    fields = {c.name for c in root.children}
    return done.withColumn("patch_code", F.when(~exists, "invalid_path")).select(
        *[F.col("_state").getField(c).alias(c) if c in fields else top(c) for c in entities.columns], "patch_code"
    )


def _exists_in(root: Node, row: Column, target: Node, numbers: list[int]) -> Column:
    ok, node, value, left = F.lit(True), root, row, list(numbers)
    while node is not target:
        node = next(c for c in node.children if c.id <= target.id <= c.end)
        if node.name is None:
            i = left.pop(0)
            ok = ok & (F.lit(i) < F.size(value))
            value = F.get(value, F.lit(i).cast("int")) if i < 2**31 else F.get(value, F.lit(-1))
        else:
            value = value.getField(node.name)
    return F.coalesce(ok, F.lit(False))


# -- refusals --------------------------------------------------------------------


def _last_before(events: DataFrame, group: list[str], value: str, query: str) -> DataFrame:
    """For each row where ``query`` is true, the last ``value`` of its group
    before ``_at``, as ``_last``.

    A plain window would bring all rows of a busy group to one task. The rows are
    range-partitioned by group and ``_at``, so a busy group spreads over many
    partitions of like size, and written with their partition's number. A window runs
    inside each (group, partition), and a second one over one summary row for each
    carries values across. Rows with no ``_at`` come before all others.
    """
    names = [quoted(g) for g in group]
    ranged = events.repartitionByRange(*names, "_at", "_base")
    placed = staged(ranged.withColumn("_chunk", F.spark_partition_id()), "ordered")
    earlier = Window.partitionBy(*names, "_chunk").orderBy("_at", "_base").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_inside", F.last(value, ignorenulls=True).over(earlier)).where(query)
    totals = placed.groupBy(*names, "_chunk").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.struct("_at", "_base"))).alias("_value")
    )
    before = Window.partitionBy(*names).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*names, "_chunk", F.last("_value", ignorenulls=True).over(before).alias("_carried"))
    joined = inside.join(carried, [*group, "_chunk"], "left")
    return joined.withColumn("_last", F.coalesce("_inside", "_carried")).drop("_inside", "_carried", "_chunk", "_base")


def _out_of_range(
    entities: DataFrame, good: DataFrame, root: Node, keys: list[str], seq: str
) -> DataFrame:
    """Key and number of the accepted patches with an index that was out of range when they came.

    All levels of a path are asked about in one ordered scan, each against the last length set on its own array, whether or
    not the patch that set it was itself in range. That is exact: where all levels above are in range, the array
    above was last set whole after any patch that missed it, and with it the arrays below. Only keys, paths and
    numbers are ordered, never values."""
    depth = array_depth(root)
    pending = good.where(F.size("idx") > 0)
    asks = F.array(*[
        F.when(F.size("idx") > level, F.struct(_array_path(root, level).alias("inst"), F.get("idx", F.lit(level)).alias("index")))
        for level in range(depth)
    ])
    asked = pending.select(
        *[top(k) for k in keys], top(seq).cast("bigint").alias("_at"), F.lit(False).alias("_base"), top(seq).alias("_seq"),
        F.inline(F.filter(asks, lambda a: a.isNotNull())),
    )
    start = _entity_lengths(entities, pending, root, keys, range(depth))
    changes = _length_changes(good, root, keys, seq, range(depth))
    events = start.unionByName(changes).unionByName(asked, allowMissingColumns=True)
    known = _last_before(events, [*keys, "inst"], "len", "index IS NOT NULL")
    missed = known.where(~F.coalesce(F.col("index") < F.col("_last"), F.lit(False)))
    return missed.select(*[top(k) for k in keys], F.col("_seq").alias(seq)).distinct()


def path_in_data(
    entities: DataFrame,
    patches: DataFrame,
    schema: T.DataType | str,
    key: str | list[str],
    seq: str,
    judged: bool = False,
) -> DataFrame:
    """The statically valid patches with ``in_data``: does the path exist in the
    entity at that point of the log? Only paths with indexes can fail, so only
    those, and the patches that set arrays, are put in order."""
    root, keys = _tree(schema), as_list(key)
    good = _accepted(_checked(patches, schema, keys, seq, judged))
    if not array_depth(root):
        return good.withColumn("in_data", F.lit(True))
    missed, _ = measured(_out_of_range(entities, good, root, keys, seq), "out-of-range")
    marked = good.join(missed.withColumn("_missed", F.lit(True)), [*keys, seq], "left")
    return marked.select(*[top(c) for c in good.columns], F.col("_missed").isNull().alias("in_data"))


def unknown_entities(entities: DataFrame, patches: DataFrame, key: str | list[str]) -> DataFrame:
    """The keys of patches that have no entity. Keys are made distinct before
    they are shuffled."""
    keys = as_list(key)
    named = [quoted(k) for k in keys]
    return patches.select(*named).distinct().join(entities.select(*named), keys, "left_anti")


def patch_rejects(
    entities: DataFrame,
    patches: DataFrame,
    schema: T.DataType | str,
    key: str | list[str],
    seq: str,
    judged: bool = False,
) -> DataFrame:
    """Every refused patch with the reason: ``(key, seq, op, path, code, depth,
    errors, raw)``. Codes are those of ``judge_log``, ``unknown_entity``, and
    ``invalid_path`` for an index that was out of range when the patch came."""
    keys = as_list(key)
    checked = _checked(patches, schema, keys, seq, judged)
    root = _tree(schema)
    columns = [*[top(k) for k in keys], top(seq), *REJECT_COLUMNS]
    refused = checked.where(F.col("code").isNotNull()).select(*columns)
    good = _accepted(checked)
    orphans, n = measured(unknown_entities(entities, good, keys), "orphans")
    if n:
        unknown = good.join(orphans, keys, "left_semi").withColumn("code", F.lit("unknown_entity"))
        refused = refused.unionByName(unknown.select(*columns))
    if not array_depth(root):
        return refused
    missed = _out_of_range(entities, good, root, keys, seq)
    missed, _ = measured(missed.join(orphans, keys, "left_anti") if n else missed, "out-of-range")
    out = good.join(missed, [*keys, seq], "left_semi").withColumn("code", F.lit("invalid_path"))
    return refused.unionByName(out.select(*columns))
