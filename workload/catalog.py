"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarn.functions.dates import zoneless_as_utc
from tarn.operators import generate, order, patches, project, shapes
from tarn.operators.validate import (
    decode,
    error_report,
    first_incompatibility,
    parse_docs,
    split_valid,
    validate,
)
from tarn.session import staged, work_dir
from tarn.sources.lake import read_json_docs, read_lake, read_parquet_as, write_lake
from tarn.streaming.ingest import stream_ingest
from tarn.streaming.state import entities_from_state, stream_latest_patches
from tarn.streaming.patches import current_entities, fold_batch, read_entities, start_entities, stream_patch_log
from workload.fixtures import ENTITY_SCHEMA, EVENT_SCHEMA, deal_out, entities, event_docs, patch_docs, table

LINEITEM_SCHEMA = (
    "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
    "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP"
)
ORDERS_SCHEMA = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority STRING"
)
LINES = LINEITEM_SCHEMA.split(", ")[1:]
NESTED_SCHEMA = f"{ORDERS_SCHEMA}, lines ARRAY<STRUCT<{', '.join(f.replace(' ', ': ') for f in LINES)}>>"
KEY, SEQ = "c_custkey", "seq"


def _docs(spark, sf_dir) -> DataFrame:
    return parse_docs(event_docs(spark, sf_dir))


def _good(spark, sf_dir) -> DataFrame:
    return split_valid(_docs(spark, sf_dir), EVENT_SCHEMA)[0]


def _log(spark, sf_dir) -> DataFrame:
    return patches.read_patch_log(patch_docs(spark, sf_dir), KEY, SEQ)


def _judged(spark, sf_dir) -> DataFrame:
    return patches.judge_log(_log(spark, sf_dir), ENTITY_SCHEMA, KEY, SEQ)


def _join_errors(field: str):
    return F.array_join(F.transform("errors", lambda e: e.getField(field)), ",")


# -- sources and sinks ---------------------------------------------------------


def q_read_json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "docs")
    event_docs(spark, sf_dir).select("raw").write.text(path)
    docs = read_json_docs(spark, path)
    return docs.select(
        F.try_variant_get("doc", "$.id", "bigint").alias("event_id"),
        F.try_variant_get("doc", "$.kind", "string").alias("kind"),
        F.try_variant_get("doc", "$.zz", "boolean").alias("extra"),
    )


def q_read_parquet_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_parquet_as(spark, f"{sf_dir}/lineitem.parquet", LINEITEM_SCHEMA)
    return rows.withColumn("l_shipdate", F.unix_millis("l_shipdate"))


def q_read_patch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_text = F.schema_of_variant("value") == "STRING"
    return _log(spark, sf_dir).select(
        KEY, SEQ, "op", "path",
        F.when(is_text, F.try_variant_get("value", "$", "string")).alias("txt"),
        F.when(~is_text, F.try_variant_get("value", "$", "double")).alias("num"),
    )


def q_write_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "lake")
    write_lake(_docs(spark, sf_dir), EVENT_SCHEMA, path, keep=["event_id"])
    return _lake_result(spark, path)


def q_write_lake_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads by name, the second run twice as after a lost job."""
    path, docs = work_dir(spark, "lake-batches"), _docs(spark, sf_dir)
    for name, part in (("even", 0), ("odd", 1), ("odd", 1)):
        write_lake(docs.where(F.col("event_id") % 2 == part), EVENT_SCHEMA, path, keep=["event_id"], batch=name)
    return _lake_result(spark, path)


def _lake_result(spark: SparkSession, path: str) -> DataFrame:
    good = read_lake(spark, path).select("event_id", F.lit(True).alias("ok"), "kind", "amount", F.lit(0).alias("n_errors"))
    bad = read_lake(spark, path, valid=False).select(
        "event_id",
        F.lit(False).alias("ok"),
        F.get_json_object("_raw", "$.kind").alias("kind"),
        F.get_json_object("_raw", "$.amount").cast("double").alias("amount"),
        F.size("_errors").alias("n_errors"),
    )
    return good.unionByName(bad)


# -- projections -----------------------------------------------------------------


def _items(column: str):
    return F.array_join(F.transform(column, lambda x: F.concat(x["p"].cast("string"), F.lit(":"), x["q"])), ",").alias("items")


def q_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = decode(_docs(spark, sf_dir), EVENT_SCHEMA)
    return rec.select(
        "event_id",
        "rec.id",
        F.unix_micros("rec.at").alias("at_us"),
        "rec.kind",
        "rec.amount",
        F.col("rec.ratio").cast("double").alias("ratio"),
        "rec.big",
        F.col("rec.user.id").alias("user_id"),
        F.col("rec.user.k").alias("user_k"),
        _items("rec.items"),
        F.col("rec.tags")[0].alias("tag"),
    )


def q_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project.to_rows(_good(spark, sf_dir), EVENT_SCHEMA)
    return rows.select(
        "id", F.unix_micros("at").alias("at_us"), "kind", "amount", F.col("ratio").cast("double").alias("ratio"), "big",
        F.col("user.id").alias("user_id"), F.col("user.k").alias("user_k"), _items("items"), F.array_join("tags", ",").alias("tags"),
    )


def q_flatten_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project.to_rows(_good(spark, sf_dir), EVENT_SCHEMA)
    flat = project.flatten_paths(rows, EVENT_SCHEMA)
    return flat.select(
        "id", F.unix_micros("at").alias("at_us"), "kind", "amount", F.col("ratio").cast("double").alias("ratio"), "big",
        "user_id", "user_k", F.array_join(F.col("items_p").cast("array<string>"), ",").alias("items_p"),
        F.array_join("items_q", ",").alias("items_q"), F.array_join("tags", ",").alias("tags"),
    )


def q_explode_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = project.explode_nodes(_good(spark, sf_dir), EVENT_SCHEMA, "event_id")
    number = F.col("type").isin("integer", "long", "float", "double")
    return leaves.select(
        "event_id", "path", "type",
        F.when(~number, F.col("value")).alias("txt"),
        F.when(number, F.col("value").cast("double")).alias("num"),
    )


def q_avro_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_parquet_as(spark, f"{sf_dir}/lineitem.parquet", LINEITEM_SCHEMA)
    return project.avro_layout(rows, LINEITEM_SCHEMA)


def q_from_avro_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project.avro_layout(read_parquet_as(spark, f"{sf_dir}/lineitem.parquet", LINEITEM_SCHEMA), LINEITEM_SCHEMA)
    back = project.from_avro_layout(rows, LINEITEM_SCHEMA)
    shown = F.to_utc_timestamp("l_shipdate", F.current_timezone())
    return back.withColumn("l_shipdate", F.date_format(shown, "yyyy-MM-dd HH:mm:ss"))


def _nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, each with an array of its lines: dates stand at the top and inside the array."""
    lines = read_parquet_as(spark, f"{sf_dir}/lineitem.parquet", LINEITEM_SCHEMA)
    line = F.struct(*[f.split()[0] for f in LINES])
    held = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(line).alias("lines"))
    orders = read_parquet_as(spark, f"{sf_dir}/orders.parquet", ORDERS_SCHEMA)
    return orders.join(held, "o_orderkey", "left").withColumn("lines", F.coalesce("lines", F.array()))


def _spread_orders(nested: DataFrame, shown) -> DataFrame:
    rows = nested.select("*", F.inline_outer("lines")).drop("lines")
    return rows.withColumns({c: shown(c) for c in ("o_orderdate", "l_shipdate")})


def q_avro_layout_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spread_orders(project.avro_layout(_nested_orders(spark, sf_dir), NESTED_SCHEMA), F.col)


def q_from_avro_layout_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = project.from_avro_layout(project.avro_layout(_nested_orders(spark, sf_dir), NESTED_SCHEMA), NESTED_SCHEMA)
    return _spread_orders(back, lambda c: F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd HH:mm:ss"))


def q_to_json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project.to_rows(_good(spark, sf_dir), EVENT_SCHEMA)
    docs = project.to_json_docs(rows, EVENT_SCHEMA, keep=["id"])
    get = lambda p: F.get_json_object("raw", p)
    return docs.select(
        "id", get("$.at").alias("at"), get("$.kind").alias("kind"), get("$.amount").cast("double").alias("amount"),
        get("$.ratio").cast("double").alias("ratio"), get("$.big").cast("boolean").alias("big"),
        get("$.user.id").cast("int").alias("user_id"), get("$.user.k").cast("int").alias("user_k"),
        get("$.items").alias("items"), get("$.tags[0]").alias("tag"),
    )


def q_round_trip_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, with all their quotes, accents and line ends, to JSON and back."""
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING"
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    docs = parse_docs(project.to_json_docs(rows, schema))
    good, _ = split_valid(docs, schema)
    back = project.to_rows(good, schema)
    return back.select("doc_id", "lang", "source", F.length("text").alias("n"), F.md5(F.col("text").cast("binary")).alias("md5"))


def q_round_trip_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
    docs = parse_docs(project.to_json_docs(table(spark, sf_dir, "conversations"), schema))
    back = project.to_rows(split_valid(docs, schema)[0], schema)
    return back.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("md5"))


def q_round_trip_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of floats to JSON and back, item by item."""
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"
    docs = parse_docs(project.to_json_docs(table(spark, sf_dir, "embeddings"), schema))
    back = project.to_rows(split_valid(docs, schema)[0], schema)
    items = back.select("vec_id", "label", F.posexplode("embedding").alias("pos", "v"))
    return items.select("vec_id", "label", "pos", F.col("v").cast("double").alias("v"))


# -- rules -------------------------------------------------------------------------

# One rule tried on each kind of value that the event documents hold.
RULE_TYPES = {
    "rule_boolean": "BOOLEAN",
    "rule_integer": "INT",
    "rule_long": "BIGINT",
    "rule_double": "DOUBLE",
    "rule_float": "FLOAT",
    "rule_string": "STRING",
    "rule_date": "TIMESTAMP",
    "rule_struct": "STRUCT<id: BIGINT>",
    "rule_array": "ARRAY<STRING>",
}


def _rule_query(dtype: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        schema = (
            f"id {dtype}, at {dtype}, kind {dtype}, amount {dtype}, big {dtype}, user {dtype}, tags {dtype}, "
            f"absent {dtype}"
        )
        checked = validate(_docs(spark, sf_dir), schema)
        return checked.select("event_id", F.inline("errors")).select("event_id", "path", "code")

    return run


def q_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(_docs(spark, sf_dir), EVENT_SCHEMA)
    return checked.select(
        "event_id", F.size("errors").alias("n_errors"), _join_errors("path").alias("paths"), _join_errors("code").alias("codes")
    )


def q_split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = split_valid(_docs(spark, sf_dir), EVENT_SCHEMA)
    return good.select("event_id", F.lit(True).alias("ok"), F.lit("").alias("codes")).unionByName(
        bad.select("event_id", F.lit(False).alias("ok"), _join_errors("code").alias("codes"))
    )


def q_first_incompatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_incompatibility(_docs(spark, sf_dir), EVENT_SCHEMA, "event_id")


def q_conform_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "l_linenumber BIGINT, l_orderkey BIGINT, l_quantity DOUBLE, l_shipdate TIMESTAMP"
    rows = project.conform_table(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), schema, allow_extra=True)
    return rows.withColumn("l_shipdate", F.unix_millis("l_shipdate"))


# -- aggregations and sorts ------------------------------------------------------------


def q_error_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return error_report(_docs(spark, sf_dir), EVENT_SCHEMA, "event_id")


def q_shape_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.shape_registry(_docs(spark, sf_dir), "event_id")


def q_shape_registry_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.shape_registry_nested(_docs(spark, sf_dir), EVENT_SCHEMA, "event_id")


def q_sort_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows in order; each row's place, so that the order itself is compared."""
    rows = order.sort_values(table(spark, sf_dir, "lineitem"), "l_quantity")
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "sorted")
    part, inside = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    placed = rows.withColumn("_part", part).join(starts, "_part")
    return placed.select((F.col("_start") + inside).alias("place"), "l_quantity")


def q_sort_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order.sort_arrays(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    items = rows.select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return items.select("vec_id", "pos", F.col("v").cast("double").alias("v"))


# -- patches ---------------------------------------------------------------------------


def q_resolve_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patches.resolve_paths(_log(spark, sf_dir), ENTITY_SCHEMA).select(
        KEY, SEQ, "path", F.col("path_id").isNotNull().alias("known"), "depth"
    )


def q_validate_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = patches.validate_patches(_log(spark, sf_dir), ENTITY_SCHEMA)
    return judged.select(KEY, SEQ, "code", _join_errors("path").alias("error_paths"), _join_errors("code").alias("error_codes"))


def q_path_in_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = patches.path_in_data(entities(spark, sf_dir), _judged(spark, sf_dir), ENTITY_SCHEMA, KEY, SEQ, judged=True)
    return placed.select(KEY, SEQ, "path", "in_data")


def q_apply_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two patches on each customer; the second needs a list of two or more scores."""
    base = entities(spark, sf_dir).withColumn("scores", F.slice("scores", F.lit(1), (F.col(KEY) % 4).cast("int")))
    once = patches.apply_patch(base, "/profile/segment", '"NEW"', ENTITY_SCHEMA).withColumnRenamed("patch_code", "first_code")
    twice = patches.apply_patch(once, "/scores/1", "42", ENTITY_SCHEMA)
    return _entity_columns(twice, "first_code", "patch_code")


def _entity_columns(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        KEY, F.col("profile.name").alias("name"), F.col("profile.segment").alias("segment"),
        F.col("profile.balance").alias("balance"),
        F.array_join(F.col("scores").cast("array<string>"), ",").alias("scores"), "active", *more,
    )


def q_compact_patch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patches.compact_patch_log(_log(spark, sf_dir), ENTITY_SCHEMA, KEY, SEQ).select(KEY, SEQ, "path")


def q_attach_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = patches.attach_patches(entities(spark, sf_dir), _log(spark, sf_dir), ENTITY_SCHEMA, KEY, SEQ)
    return rows.select(
        KEY, F.coalesce(F.size("patches"), F.lit(0)).alias("n"), "last_seq",
        F.array_join(F.transform("patches", lambda p: p.getField("path")), ",").alias("paths"),
    )


def q_apply_patch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entity_columns(patches.apply_patch_log(entities(spark, sf_dir), _log(spark, sf_dir), ENTITY_SCHEMA, KEY, SEQ))


def q_apply_redelivered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with every third message delivered twice and every fifteenth a third time: the entities are the same."""
    docs = patch_docs(spark, sf_dir)
    again = docs.where(F.col(SEQ) % 3 == 0).unionByName(docs.where(F.col(SEQ) % 15 == 0))
    log = patches.read_patch_log(docs.unionByName(again), KEY, SEQ)
    return _entity_columns(patches.apply_patch_log(entities(spark, sf_dir), log, ENTITY_SCHEMA, KEY, SEQ))


def q_patch_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = patches.patch_rejects(entities(spark, sf_dir), _judged(spark, sf_dir), ENTITY_SCHEMA, KEY, SEQ, judged=True)
    return out.select(KEY, SEQ, "op", "path", "code")


def q_patch_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log under keys eleven times as large, some of them no customer's."""
    log = _judged(spark, sf_dir).withColumn(KEY, F.col(KEY) * 11)
    out = patches.patch_rejects(entities(spark, sf_dir), log, ENTITY_SCHEMA, KEY, SEQ, judged=True)
    return out.select(KEY, SEQ, "path", "code")


def q_patch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each patch of a log with missing keys, missing and repeated
    numbers, broken documents and messages delivered again: refused with a code, applied, or overwritten."""
    log, at = patch_docs(spark, sf_dir), F.col(SEQ)
    broken = log.select(
        F.when(at % 97 != 0, F.col(KEY)).alias(KEY),
        F.when(at % 89 == 1, None).when(at % 7 == 3, at - at % 300).otherwise(at).alias(SEQ),
        F.when(at % 61 == 5, F.lit("oops")).otherwise(F.col("doc")).alias("doc"),
    )
    again = broken.where(F.col(KEY).isNotNull() & (F.col(SEQ) % 13 == 0))
    log = patches.read_patch_log(broken.unionByName(again), KEY, SEQ)
    judged = patches.judge_log(log, ENTITY_SCHEMA, KEY, SEQ)
    base = entities(spark, sf_dir)
    refused = patches.patch_rejects(base, judged, ENTITY_SCHEMA, KEY, SEQ, judged=True).select(F.col("code").alias("outcome"), F.lit(1).alias("n"))
    good = patches.path_in_data(base, judged, ENTITY_SCHEMA, KEY, SEQ, judged=True).where("in_data")
    kept = patches.attach_patches(base, judged, ENTITY_SCHEMA, KEY, SEQ, judged=True).select(
        F.coalesce(F.size("patches"), F.lit(0)).alias("n")
    )
    rows = refused.unionByName(good.select(F.lit("overwritten").alias("outcome"), F.lit(1).alias("n")))
    rows = rows.unionByName(kept.select(F.lit("applied").alias("outcome"), "n"))
    rows = rows.unionByName(kept.select(F.lit("overwritten").alias("outcome"), (-F.col("n")).alias("n")))
    return rows.groupBy("outcome").agg(F.sum("n").alias("n")).where("n <> 0")


def q_patch_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten patches on items of each vector, some of them past its end."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    log = vectors.select("vec_id", F.explode(F.sequence(F.lit(0), F.lit(9))).alias(SEQ))
    index = ((F.col("vec_id") * 7 + F.col(SEQ) * F.col(SEQ)) % 70).cast("string")
    doc = F.concat(
        F.lit('{"op":"replace","path":"/embedding/'), index, F.lit('","value":'), F.col(SEQ).cast("string"), F.lit("}")
    )
    log = patches.read_patch_log(log.withColumn("doc", doc), "vec_id", SEQ)
    done = patches.apply_patch_log(vectors, log, "embedding ARRAY<FLOAT>", "vec_id", SEQ)
    items = done.select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return items.select("vec_id", "pos", F.col("v").cast("double").alias("v"))


def q_duplicate_seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence numbers of the log cut to the hour: some now occur twice."""
    hours = table(spark, sf_dir, "events").select(
        F.col("user_id").alias(KEY), F.floor(F.unix_micros(zoneless_as_utc(F.col("ts"))) / F.lit(3_600_000_000)).alias(SEQ)
    )
    return patches.duplicate_seqs(hours, KEY, SEQ)


# -- streams ---------------------------------------------------------------------------


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, out, ckpt = (work_dir(spark, f"ingest-{n}") for n in ("source", "out", "checkpoint"))
    files = deal_out(event_docs(spark, sf_dir), source, least=4)
    docs = spark.readStream.schema("event_id BIGINT, raw STRING").option("maxFilesPerTrigger", -(-files // 2)).parquet(source)
    stream_ingest(docs, EVENT_SCHEMA, out, ckpt, keep=["event_id"], once=True).awaitTermination()
    return _lake_result(spark, out)


def q_stream_patch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, out, ckpt = (work_dir(spark, f"patches-{n}") for n in ("source", "out", "checkpoint"))
    files = deal_out(patch_docs(spark, sf_dir), source, least=4)
    docs = spark.readStream.schema(f"{KEY} BIGINT, {SEQ} BIGINT, doc STRING")
    docs = docs.option("maxFilesPerTrigger", -(-files // 2)).parquet(source)
    stream_patch_log(docs, ENTITY_SCHEMA, KEY, SEQ, out, ckpt, once=True).awaitTermination()
    return _entity_columns(current_entities(entities(spark, sf_dir), out, ENTITY_SCHEMA, KEY, SEQ))


def q_stream_apply_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body of the patch stream on two batches, the second run twice: the
    entities, with what was refused of their patches."""
    out = work_dir(spark, "entities")
    start_entities(entities(spark, sf_dir), out, KEY)
    run = fold_batch(ENTITY_SCHEMA, KEY, SEQ, out)
    log = patch_docs(spark, sf_dir)
    half = log.agg((F.max(SEQ) / 2).cast("bigint")).first()[0]
    run(log.where(F.col(SEQ) <= half), 0)
    run(log.where(F.col(SEQ) > half), 1)
    run(log.where(F.col(SEQ) > half), 1)
    refused = spark.read.parquet(f"{out}/rejects").groupBy(KEY).agg(
        F.count_if(F.col("code") == "invalid_path").alias("bad_paths"), F.count_if(F.col("code") == "invalid_patch").alias("bad_values")
    )
    rows = read_entities(spark, out).join(refused, KEY, "left").fillna(0, ["bad_paths", "bad_values"])
    return _entity_columns(rows, "bad_paths", "bad_values")


def q_stream_latest_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest patches as stream state: half of the log, then, after a restart, all of it."""
    source, ckpt = (work_dir(spark, f"latest-{n}") for n in ("source", "checkpoint"))
    log = patch_docs(spark, sf_dir)
    for part in (log.where(F.col(SEQ) % 2 == 0), log):
        deal_out(part, source, least=2)
        docs = spark.readStream.schema(f"{KEY} BIGINT, {SEQ} BIGINT, doc STRING").parquet(source)
        stream_latest_patches(docs, ENTITY_SCHEMA, KEY, SEQ, ckpt, once=True).awaitTermination()
    return _entity_columns(entities_from_state(entities(spark, sf_dir), ckpt, ENTITY_SCHEMA, KEY, SEQ))


def q_stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body of the patch stream on batches that come out of order and overlap."""
    out, log = work_dir(spark, "redelivered"), patch_docs(spark, sf_dir)
    start_entities(entities(spark, sf_dir), out, KEY)
    run = fold_batch(ENTITY_SCHEMA, KEY, SEQ, out)
    for batch, wanted in enumerate((F.col(SEQ) % 5 < 3, F.col(SEQ) % 5 > 1)):
        run(log.where(wanted), batch)
    return _entity_columns(read_entities(spark, out))


# -- synthetic data --------------------------------------------------------------------


def q_generate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A random record per event, as a document, judged: all must fit."""
    rows = generate.generate_rows(table(spark, sf_dir, "events"), EVENT_SCHEMA, "event_id", seed=7)
    docs = parse_docs(project.to_json_docs(rows, EVENT_SCHEMA, keep=["event_id"]))
    return validate(docs, EVENT_SCHEMA).select("event_id", F.size("errors").alias("n_errors"))


def q_generate_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three random patches per customer, judged: all fit the schema, and the first
    one of an entity never fails."""
    base = entities(spark, sf_dir)
    made = generate.generate_patches(base, ENTITY_SCHEMA, KEY, n=3, seed=7)
    log = patches.read_patch_log(made.withColumn(SEQ, F.col("nth").cast("bigint")), KEY, SEQ)
    placed = patches.path_in_data(base, log, ENTITY_SCHEMA, KEY, SEQ)
    first = F.bool_or((F.col(SEQ) == 0) & F.col("in_data"))
    return placed.groupBy(KEY).agg(F.count("*").alias("n_patches"), first.alias("first_in_data"))


def q_corrupt_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents broken in a known place, judged: found is what was put in."""
    rows = generate.generate_rows(table(spark, sf_dir, "events"), EVENT_SCHEMA, "event_id", seed=3)
    broken = generate.corrupt_docs(rows, EVENT_SCHEMA, "event_id", 0.5, seed=3)
    first = F.get("errors", F.lit(0))
    checked = validate(parse_docs(broken), EVENT_SCHEMA)
    agrees = first["path"].eqNullSafe(F.col("expected_path")) & first["code"].eqNullSafe(F.col("expected_code"))
    return checked.select("event_id", (agrees & (F.size("errors") <= 1)).alias("agrees"))


def queries() -> dict:
    found = {name[2:]: f for name, f in globals().items() if name.startswith("q_")}
    found.update({name: _rule_query(dtype) for name, dtype in RULE_TYPES.items()})
    return found
