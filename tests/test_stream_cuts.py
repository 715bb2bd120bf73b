"""The patch stream against the batch result, however the log is cut, ordered and repeated."""

import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from tarn.operators.patches import apply_patch_log, read_patch_log
from tarn.session import claim
from tarn.streaming import patches as S

SCHEMA = "a INT, nums ARRAY<INT>"
DOCS = "k BIGINT, seq BIGINT, doc STRING"


def start(spark, n=6):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(0).alias("a"), F.array(F.lit(1), F.lit(2)).alias("nums"))


def frame(spark, rows):
    docs = [(k, s, json.dumps({"op": "replace", "path": p, "value": v})) for k, s, p, v in rows]
    return spark.createDataFrame(docs, DOCS)


def state(df):
    return {r["k"]: (r["a"], r["nums"], r["last_seq"]) for r in df.select("k", "a", "nums", "last_seq").collect()}


def make_log(rng):
    paths = [("/a", lambda: rng.randrange(99)), ("/nums", lambda: [5] * rng.randrange(5)), ("/nums/1", lambda: rng.randrange(9)),
             ("/nums/3", lambda: 7), ("/a", lambda: "bad"), ("", lambda: {"a": rng.randrange(9), "nums": [1, 2, 3]})]
    log = []
    for i in range(60):
        path, value = rng.choice(paths)
        log.append((rng.randrange(7), i // 2, path, value()))
    log += rng.sample(log, 15)
    # Numbers that name two different patches.
    return log + [(k, s, "/a", 1000 + i) for i, (k, s, _, _) in enumerate(rng.sample(log, 4))]


@pytest.mark.parametrize("seed", range(2))
def test_any_cut_and_order_gives_the_batch_result(spark, tmp_path, seed):
    rng, out = random.Random(seed), str(tmp_path / "e")
    log = make_log(rng)
    wanted = state(apply_patch_log(start(spark), read_patch_log(frame(spark, log), "k", "seq"), SCHEMA, "k", "seq"))
    S.start_entities(start(spark), out, "k")
    run = S.fold_batch(SCHEMA, "k", "seq", out)
    if seed:
        rng.shuffle(log)
    cuts = sorted(rng.sample(range(len(log)), 2))
    parts = [log[: cuts[0]], log[cuts[0] : cuts[1]], log[cuts[1] :] + rng.sample(log, 20)]
    for i, part in enumerate(parts):
        run(frame(spark, part), i)
    assert state(S.read_entities(spark, out)) == wanted
    assert S.read_entities(spark, out).columns == ["k", "a", "nums", "last_seq"]


def test_a_redelivered_number_that_says_something_else_is_undone(spark, tmp_path):
    out = str(tmp_path / "e")
    S.start_entities(start(spark, 2), out, "k")
    run = S.fold_batch(SCHEMA, "k", "seq", out)
    run(frame(spark, [(0, 4, "/a", 4), (0, 5, "/a", 5), (1, 1, "/a", 1)]), 0)
    run(frame(spark, [(0, 5, "/a", 5)]), 1)
    assert state(S.read_entities(spark, out))[0] == (5, [1, 2], 5)
    run(frame(spark, [(0, 5, "/a", 6), (9, 1, "/a", 1)]), 2)
    assert state(S.read_entities(spark, out)) == {0: (4, [1, 2], 4), 1: (1, [1, 2], 1)}
    refused = spark.read.parquet(f"{out}/rejects/version=2").collect()
    assert sorted((r["k"], r["seq"], r["code"], r["rebuilt"]) for r in refused) == [
        (0, 5, "duplicate_seq", True), (0, 5, "duplicate_seq", True), (9, 1, "unknown_entity", False)
    ]
    # Late, and only for keys that are not there.
    run(frame(spark, [(0, 3, "/nums", [])]), 3)
    run(frame(spark, [(8, 1, "/a", 1)]), 4)
    assert state(S.read_entities(spark, out)) == {0: (4, [], 4), 1: (1, [1, 2], 1)}


def test_buckets_split_by_their_bytes(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "e")
    monkeypatch.setattr(S, "BUCKET_BYTES", 6_000)
    n = 4000
    S.start_entities(start(spark, n).withColumn("text", F.sha2(F.col("k").cast("string"), 256)), out, "k")
    sizes = {r["bucket"]: r["bytes"] for r in S._sizes(spark, f"{out}/entities/version=-1").collect()}
    files = list((tmp_path / "e/entities/version=-1").rglob("*.parquet"))
    assert len(sizes) == len(files) > 64 and max(sizes.values()) <= 6_000
    log = [(k, 1, "/a", k) for k in range(0, n, 400)]
    S.fold_batch(SCHEMA, "k", "seq", out)(frame(spark, log), 0)
    assert len(list((tmp_path / "e/entities/version=0").rglob("*.parquet"))) <= len(log)
    rows = S.read_entities(spark, out)
    assert rows.count() == rows.distinct().count() == n and rows.where("a = k AND k > 0").count() == len(log) - 1


def test_one_writer(spark, tmp_path):
    out = str(tmp_path / "e")
    S.start_entities(start(spark, 2), out, "k")
    own, other = (S.fold_batch(SCHEMA, "k", "seq", out, stream=name) for name in ("own", "other"))
    # The stream ``own`` has begun a version, and did not commit it.
    assert claim(spark, f"{out}/claims/version=0", "own#0")
    with pytest.raises(RuntimeError, match="another stream"):
        other(frame(spark, [(0, 1, "/a", 1)]), 0)
    own(frame(spark, [(0, 1, "/a", 1)]), 0)
    other(frame(spark, [(0, 2, "/a", 2)]), 0)
    assert state(S.read_entities(spark, out))[0] == (2, [1, 2], 2)


def test_two_streams_of_one_driver_keep_their_tables(spark, tmp_path):
    failed = []

    def stream(name):
        try:
            out = str(tmp_path / name)
            S.start_entities(start(spark, 3), out, "k")
            run = S.fold_batch(SCHEMA, "k", "seq", out)
            for i in range(2):
                run(frame(spark, [(k, i + 1, "/a", i + 1) for k in range(3)]), i)
            assert {v[0] for v in state(S.read_entities(spark, out)).values()} == {2}
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=stream, args=(n,)) for n in ("one", "two")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
