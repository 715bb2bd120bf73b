import json

from pyspark.sql import functions as F

from tarn.sources.lake import read_lake
from tarn.streaming.ingest import stream_ingest
from tarn.streaming.state import entities_from_state, latest_patches, stream_latest_patches
from tarn.streaming.patches import current_entities, fold_batch, read_entities, start_entities, stream_patch_log
from tests.replay import replay
from tests.test_patches import SCHEMA, fits, make_log, state_of, to_frames, types_at


def test_ingest_restarts_add_nothing(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("source", "out", "ckpt"))
    raws = spark.range(1000).select(
        "id", F.when(F.col("id") % 5 == 0, F.lit('{"a":"x"}')).otherwise(F.concat(F.lit('{"a":'), "id", F.lit("}"))).alias("raw")
    )
    raws.repartition(4).write.parquet(source)
    for _ in range(2):
        docs = spark.readStream.schema("id BIGINT, raw STRING").option("maxFilesPerTrigger", 1).parquet(source)
        stream_ingest(docs, "a INT", out, ckpt, keep=["id"], once=True).awaitTermination()
    assert read_lake(spark, out).where("a = id").count() == 800
    assert read_lake(spark, out, valid=False).where("_errors[0].code = 'type'").count() == 200


def test_patch_stream_equals_batch(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("source", "out", "ckpt"))
    entities, log = make_log(11, n=150)
    e, p = to_frames(spark, entities, log)
    docs = [(k, s, json.dumps({"op": op, "path": path, "value": v})) for k, s, op, path, v in log]
    spark.createDataFrame(docs, "k BIGINT, seq BIGINT, doc STRING").repartition(3).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema("k BIGINT, seq BIGINT, doc STRING").option("maxFilesPerTrigger", 1).parquet(source)
        stream_patch_log(stream, SCHEMA, "k", "seq", out, ckpt, once=True).awaitTermination()
    assert spark.read.parquet(out).count() == 150
    wanted, _ = replay(entities, log, fits, types_at)
    assert state_of(current_entities(e, out, SCHEMA, "k", "seq")) == wanted


def test_state_holds_the_latest_patches_over_restarts(spark, tmp_path):
    source, ckpt = (str(tmp_path / n) for n in ("source", "ckpt"))
    entities, log = make_log(13, n=120)
    e, _ = to_frames(spark, entities, log)
    wanted, _ = replay(entities, log, fits, types_at)
    docs = [(k, s, json.dumps({"op": op, "path": path, "value": v})) for k, s, op, path, v in log]
    # Later halves first, then everything again.
    for part in (docs[60:], docs[30:], docs):
        spark.createDataFrame(part, "k BIGINT, seq BIGINT, doc STRING").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("k BIGINT, seq BIGINT, doc STRING").parquet(source)
        stream_latest_patches(stream, SCHEMA, "k", "seq", ckpt, once=True).awaitTermination()
    assert state_of(entities_from_state(e, ckpt, SCHEMA, "k", "seq")) == wanted
    held = latest_patches(spark, ckpt, "k", "seq")
    assert held.count() == held.select("k", "path").distinct().count() <= 120


def test_batches_replays_and_late_patches(spark, tmp_path):
    out = str(tmp_path / "entities")
    entities, log = make_log(12, n=120)
    e, _ = to_frames(spark, entities, log)
    start_entities(e, out, "k")
    run = fold_batch(SCHEMA, "k", "seq", out)

    def batch(part):
        docs = [(k, s, json.dumps({"op": op, "path": path, "value": v})) for k, s, op, path, v in part]
        return spark.createDataFrame(docs, "k BIGINT, seq BIGINT, doc STRING")

    run(batch(log[:60]), 0)
    after_first, _ = replay(entities, log[:60], fits, types_at)
    assert state_of(read_entities(spark, out)) == after_first
    run(batch(log[:60]), 0)  # the same batch again
    # The next batch holds the first one's patches once more.
    run(batch(log), 1)
    wanted, _ = replay(entities, log, fits, types_at)
    marks = {r["k"]: r["last_seq"] for r in spark.read.parquet(f"{out}/entities/version=0").collect()}
    assert state_of(read_entities(spark, out)) == wanted
    rejects = spark.read.parquet(f"{out}/rejects/version=1").collect()
    stale = {(r["k"], r["seq"]) for r in rejects if r["code"] == "stale_seq"}
    assert stale == {(k, s) for k, s, *_ in log if marks.get(k) is not None and s <= marks[k]}
