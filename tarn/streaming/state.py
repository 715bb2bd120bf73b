"""Entities from a stream of patches whose latest patches are held in the state store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tarn.operators.patches import apply_patch_log, content, read_patch_log, validate_patches
from tarn.plans.columns import as_list, quoted, top


def stream_latest_patches(
    docs: DataFrame,
    schema: T.DataType | str,
    key: str | list[str],
    seq: str,
    checkpoint: str,
    doc: str = "doc",
    once: bool = False,
    **trigger,
) -> StreamingQuery:
    """Keep the latest valid patch of each node of each entity as the state of a streaming aggregation. Nothing else is
    written: ``latest_patches`` reads the state. So no table is rewritten by a batch, patches may come late,
    again and in any order, and the state grows with the nodes that were patched, not with the log.

    A number is taken to name one message of its entity. Where it names two for one node, the same one is always kept. The
    state outgrows the executors' memory unless the session sets the RocksDB provider
    (``spark.sql.streaming.stateStore.providerClass``)."""
    keys = as_list(key)
    judged = validate_patches(read_patch_log(docs, key, seq, doc), schema)
    known = F.greatest(*[top(c).isNull() for c in (*keys, seq)]) == F.lit(False)
    patch = F.struct(top(seq).alias("seq"), content().alias("content"), F.to_json("value").alias("value"))
    latest = judged.where(F.col("code").isNull() & known).groupBy(*[quoted(k) for k in keys], "path").agg(F.max(patch).alias("latest"))
    # The sink drops what it is given: the result is the state itself.
    writer = latest.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    timing = {"availableNow": True} if once else trigger
    return (writer.trigger(**timing) if timing else writer).start()


def latest_patches(spark: SparkSession, checkpoint: str, key: str | list[str], seq: str) -> DataFrame:
    """The log ``(key, seq, op, path, value, raw)`` of the latest patches, read from the last committed state by tasks, one per
    partition of the store."""
    state = spark.read.format("statestore").load(checkpoint)
    held = F.col("value.max")
    return state.select(
        *[F.col("key").getField(k).alias(k) for k in as_list(key)],
        held.getField("seq").alias(seq),
        F.lit("replace").alias("op"),
        F.col("key.path").alias("path"),
        F.parse_json(held.getField("value")).alias("value"),
        F.lit(None).cast("string").alias("raw"),
    )


def entities_from_state(entities: DataFrame, checkpoint: str, schema: T.DataType | str, key: str | list[str], seq: str) -> DataFrame:
    """The entities with all patches met so far applied."""
    return apply_patch_log(entities, latest_patches(entities.sparkSession, checkpoint, key, seq), schema, key, seq)
