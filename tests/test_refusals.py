"""Edges: patterns, names, files, refusal codes and restarted streams."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tarn.functions.dates import iso_timestamp
from tarn.functions.pointers import is_pointer
from tarn.operators import patches as P
from tarn.operators.project import to_json_docs
from tarn.plans.schema import SchemaError
from tarn.sources.lake import read_parquet_as
from tarn.streaming.patches import fold_batch, read_entities, start_entities

SCHEMA = "a INT, b STRUCT<c: INT>, nums ARRAY<INT>, rows ARRAY<STRUCT<x: INT, deep: ARRAY<INT>>>"


def log_of(spark, rows, key="STRING"):
    docs = [(k, s, d if isinstance(d, str) else json.dumps({"op": "replace", "path": d[0], "value": d[1]})) for k, s, d in rows]
    return P.read_patch_log(spark.createDataFrame(docs, f"k {key}, seq BIGINT, doc STRING"), "k", "seq")


def entities_of(spark, keys):
    ks = spark.createDataFrame([(k,) for k in keys], "k STRING")
    return ks.selectExpr(
        "k", "1 AS a", "named_struct('c', 1) AS b", "array(1, 2, 3) AS nums",
        "array(named_struct('x', 1, 'deep', array(1, 2)), named_struct('x', 2, 'deep', array(3))) AS rows",
    )


def test_long_paths_and_last_newlines(spark):
    paths = ["", "/a", "/a~0~1", "/" + "a" * 1_000_000, "a", "/~", "/~2", "/a~"]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i INT, p STRING")
    got = [r[0] for r in rows.orderBy("i").select(is_pointer(F.col("p"))).collect()]
    assert got == [True] * 4 + [False] * 4
    log = log_of(spark, [("x", 1, ("/" + "7" * 1_000_000, 1)), ("x", 2, ("/a\n", 1)), ("x", 3, ("/nums/0\n", 1))])
    codes = {r["seq"]: r["code"] for r in P.validate_patches(log, SCHEMA).collect()}
    assert codes == {1: "invalid_path", 2: "invalid_path", 3: "invalid_path"}
    dates = spark.createDataFrame([("2020-01-01T10:00:00Z\n",), ("2020-01-01\n",), ("2020-01-01",)], "t STRING")
    assert [r[0] is None for r in dates.select(iso_timestamp(F.col("t"))).collect()] == [True, True, False]


def test_every_patch_is_applied_overwritten_or_refused(spark):
    rows = [
        ("x", 1, ("/a", 5)), ("x", 1, ("/a", 6)), ("x", 2, ("/b/c", 7)), ("x", 3, ("/b/c", 8)), (None, 4, ("/a", 1)),
        ("x", None, ("/a", 1)), ("x", 5, "no json"), ("x", 6, "[1]"), ("x", 7, ("/nums", [9])), ("y", 7, ("/a", 1)),
        ("x", 8, ("/nums/2", 0)), ("x", 9, ("/nums", [4, 4])), ("x", 9, ("/nums/0", 5)),
    ]
    e, log = entities_of(spark, ["x"]), log_of(spark, rows)
    refused = P.patch_rejects(e, log, SCHEMA, "k", "seq").collect()
    assert sorted((r["k"] or "", r["seq"] or 0, r["code"]) for r in refused) == sorted([
        ("x", 1, "duplicate_seq"), ("x", 1, "duplicate_seq"), ("", 4, "no_key"), ("x", 0, "no_seq"), ("x", 5, "malformed"),
        ("x", 6, "malformed"), ("y", 7, "unknown_entity"), ("x", 8, "invalid_path"), ("x", 9, "duplicate_seq"), ("x", 9, "duplicate_seq"),
    ])
    assert {r["raw"] for r in refused if r["code"] == "malformed"} == {"no json", "[1]"}
    state = P.apply_patch_log(e, log, SCHEMA, "k", "seq").first()
    assert (state["a"], state["b"]["c"], state["nums"]) == (1, 8, [9])


def test_a_message_delivered_again_counts_once(spark):
    rows = [
        ("x", 5, ("/a", 7)), ("x", 5, ("/a", 7)), ("x", 6, ("/b/c", 2)), ("x", 6, ("/b/c", 3)), ("x", 6, ("/b/c", 3)),
        ("x", 7, "no json"), ("x", 7, "no json"), (None, 8, ("/a", 1)), (None, 8, ("/a", 1)),
    ]
    rows += [("x", 9, '{"op":"replace","path":"","value":{"rows":[],"nums":[],"b":{"c":4},"a":7}}'), ("x", 9, ("", {"a": 7, "b": {"c": 4}, "nums": [], "rows": []}))]
    e, log = entities_of(spark, ["x"]), log_of(spark, rows)
    refused = P.patch_rejects(e, log, SCHEMA, "k", "seq").collect()
    assert sorted((r["seq"], r["code"]) for r in refused) == [
        (6, "duplicate_seq"), (6, "duplicate_seq"), (7, "malformed"), (8, "no_key"), (8, "no_key")
    ]
    state = P.apply_patch_log(e, log, SCHEMA, "k", "seq").first()
    assert (state["a"], state["b"]["c"], state["nums"], state["last_seq"]) == (7, 4, [], 9)


def plan_of(df):
    """The physical plan as it ran."""
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()
    return qe.executedPlan().toString()


def test_judging_adds_no_exchange_of_the_log(spark):
    rows = [("x", i, ("/nums/1", i)) for i in range(20)] + [("x", 3, ("/a", 1)), ("x", 4, ("/nums/1", 4)), (None, 1, ("/a", 1))]
    e, log = entities_of(spark, ["x"]), log_of(spark, rows)
    count = lambda patches, **kw: plan_of(P.patch_rejects(e, patches, SCHEMA, "k", "seq", **kw)).count("Exchange hashpartitioning")
    done = P.staged(P.judge_log(log, SCHEMA, "k", "seq"), "judged")
    assert count(log) == count(done, judged=True)


def test_results_are_the_same_beyond_the_broadcast_limit(spark, monkeypatch):
    rows = [("x", i, (f"/nums/{i % 5}", i)) for i in range(30)] + [("x", 3, ("/a", 1)), ("x", 4, ("/nums/4", 4)), ("y", 1, ("/a", 1))]
    e, log = entities_of(spark, ["x"]), log_of(spark, rows)

    def both():
        state = P.apply_patch_log(e, log, SCHEMA, "k", "seq").collect()
        return state, sorted(P.patch_rejects(e, log, SCHEMA, "k", "seq").select("k", "seq", "path", "code").collect())

    small = both()
    monkeypatch.setattr("tarn.session.BROADCAST_BYTES", 0)
    assert both() == small


def test_taken_names_are_refused(spark):
    with pytest.raises(SchemaError):
        P.read_patch_log(spark.createDataFrame([(1, 1, "{}")], "code BIGINT, seq BIGINT, doc STRING"), "code", "seq")
    with pytest.raises(SchemaError):
        P.resolve_paths(log_of(spark, [("x", 1, ("/a", 1))]), "patches INT")


def test_keys_of_other_types_in_a_file(spark, tmp_path):
    path = str(tmp_path / "log.json")
    lines = ['{"k":"u-1","seq":1,"op":"replace","path":"/a","value":2}', '{"k":"u-1","seq":1.5,"op":"replace","path":"/a","value":3}', '{"k":5,"seq":true}']
    with open(path, "w") as f:
        f.write("\n".join(lines))
    got = P.read_patch_log(path, "k", "seq", spark=spark, key_schema="k STRING").collect()
    assert [(r["k"], r["seq"]) for r in got] == [("u-1", 1), ("u-1", None), (None, None)]


def test_declared_columns_must_be_in_the_file(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS a, 'x' AS b").write.parquet(path)
    assert read_parquet_as(spark, path, "a BIGINT").first()["a"] == 1
    for schema in ("a INT, c INT", "b INT"):
        with pytest.raises(SchemaError):
            read_parquet_as(spark, path, schema)


def test_kept_columns_may_have_any_name(spark, tmp_path):
    from tarn.operators.validate import parse_docs
    from tarn.sources.lake import read_lake, write_lake

    docs = spark.createDataFrame([('{"a":1}', "kept", "too"), ('{"a":"x"}', "kept", "too")], "raw STRING, errors STRING, rec STRING")
    write_lake(parse_docs(docs), "a INT", str(tmp_path / "lake"), keep=["errors", "rec"])
    assert read_lake(spark, str(tmp_path / "lake")).first().asDict() == {"errors": "kept", "rec": "too", "a": 1}


def test_null_fields_stay_in_documents(spark):
    row = spark.sql("SELECT CAST(NULL AS INT) AS a, named_struct('c', CAST(NULL AS INT)) AS b")
    assert json.loads(to_json_docs(row, "a INT, b STRUCT<c: INT>").first()["raw"]) == {"a": None, "b": {"c": None}}


def test_nested_items_in_order(spark):
    rows = [
        ("x", 1, ("/rows/0/x", 5)), ("x", 2, ("/rows/0", {"x": 6, "deep": [7, 8, 9]})), ("x", 3, ("/rows/0/deep/2", 1)),
        ("x", 4, ("/rows/1/deep/0", 4)), ("x", 5, ("/rows/1/deep/1", 4)), ("x", 6, ("/nums/1", 0)),
    ]
    state = P.apply_patch_log(entities_of(spark, ["x"]), log_of(spark, rows), SCHEMA, "k", "seq").first()
    assert [(r["x"], r["deep"]) for r in state["rows"]] == [(6, [7, 8, 1]), (2, [4])]
    assert state["nums"] == [1, 0, 3]


def test_many_patches_on_a_long_array(spark):
    n = 8000
    e = spark.range(1).select(F.lit("x").alias("k"), F.sequence(F.lit(1), F.lit(n)).alias("nums"))
    log = spark.range(n).select(
        F.lit("x").alias("k"), F.col("id").alias("seq"), F.lit("replace").alias("op"),
        F.concat(F.lit("/nums/"), F.col("id").cast("string")).alias("path"), F.try_parse_json(F.lit("0")).alias("value"),
    )
    start = time.time()
    state = P.apply_patch_log(e, log, "nums ARRAY<INT>", "k", "seq").select(F.aggregate("nums", F.lit(0), lambda a, x: a + x)).first()
    assert state[0] == 0 and time.time() - start < 15


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    out = str(tmp_path / "entities")
    start_entities(entities_of(spark, ["x", "y"]), out, "k")
    docs = lambda s, v: spark.createDataFrame([("x", s, json.dumps({"op": "replace", "path": "/a", "value": v}))], "k STRING, seq BIGINT, doc STRING")
    old, new = (fold_batch(SCHEMA, "k", "seq", out, stream=name) for name in ("old", "new"))
    old(docs(1, 10), 0)
    old(docs(2, 20), 1)
    new(docs(3, 30), 0)
    new(docs(3, 30), 0)
    assert {r["k"]: r["a"] for r in read_entities(spark, out).collect()} == {"x": 30, "y": 1}
    # Each batch on one key wrote one bucket, and only the kept versions are left.
    written = {p.name: sorted(b.name for b in p.glob("_bucket=*")) for p in (tmp_path / "entities/entities").glob("version=*")}
    assert len(written["version=-1"]) == 1 and written["version=0"] == [] and len(written["version=1"]) == len(written["version=2"]) == 1
    assert {r["k"]: r["a"] for r in read_entities(spark, out, 1).collect()} == {"x": 20, "y": 1}


def test_validation_has_no_exchange_and_a_log_is_parsed_once(spark):
    from tarn.operators.validate import parse_docs, validate

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(validate(parse_docs(spark.createDataFrame([("{}",)], "raw STRING")), SCHEMA))
    e, log = entities_of(spark, ["x"]), log_of(spark, [("x", 1, ("/nums/0", 1))])
    made = plan(P.patch_rejects(e, log, SCHEMA, "k", "seq"))
    assert "parse_json" not in made and "LeftSemi" in plan(P.apply_patch_log(e, log, SCHEMA, "k", "seq"))
