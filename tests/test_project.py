import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.operators import generate, order, project, shapes
from tarn.operators.validate import parse_docs, split_valid, validate
from tarn.plans.schema import SchemaError
from tarn.sources.lake import read_json_docs, read_lake, read_parquet_as, write_lake

LEAVES = [
    T.BooleanType(), T.DateType(), T.DoubleType(), T.FloatType(), T.IntegerType(), T.LongType(), T.StringType(),
    T.TimestampType(),
]


def sample_type(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.5:
        return rng.choice(LEAVES)
    if kind < 0.8:
        return T.StructType(
            [T.StructField(f"a{i}" + rng.choice(["", "x y", ".z"]), sample_type(rng, depth - 1)) for i in range(rng.randint(1, 4))]
        )
    return T.ArrayType(sample_type(rng, depth - 1))


def sample_schema(seed):
    rng = random.Random(seed)
    return T.StructType([T.StructField(f"c{i}", sample_type(rng, 3)) for i in range(rng.randint(1, 5))])


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_generated_rows_survive_json_and_avro(spark, seed):
    schema = sample_schema(seed)
    rows = generate.generate_rows(spark.range(50), schema, seed=seed)
    docs = parse_docs(project.to_json_docs(rows, schema, keep=["id"]))
    good, bad = split_valid(docs, schema)
    assert bad.count() == 0
    back = project.to_rows(good, schema, keep=["id"])
    assert same_rows(rows, back)
    again = project.from_avro_layout(project.avro_layout(rows, schema), schema)
    cut = project.from_avro_layout(project.avro_layout(again, schema), schema)
    assert same_rows(again, cut)


@pytest.mark.parametrize("seed", range(3))
def test_broken_documents_are_told_apart(spark, seed):
    schema = sample_schema(seed + 100)
    rows = generate.generate_rows(spark.range(300), schema, seed=seed)
    broken = generate.corrupt_docs(rows, schema, "id", 0.6, seed)
    found = validate(parse_docs(broken), schema).select("id", "expected_path", "expected_code", "errors").collect()
    assert sum(r["expected_code"] is not None for r in found) > 100
    for r in found:
        wanted = [] if r["expected_code"] is None else [(r["expected_path"], r["expected_code"])]
        assert [(e["path"], e["code"]) for e in r["errors"]] == wanted


def test_generated_values_cover_their_ranges(spark):
    rows = generate.generate_rows(spark.range(2000), "i INT, l BIGINT, d DOUBLE, f FLOAT, s STRING, a ARRAY<INT>")
    r = rows.agg(
        F.min("i"), F.max("i"), F.min("l"), F.max("l"), F.min("d"), F.max("d"), F.max(F.length("s")), F.min(F.length("s")),
        F.max(F.size("a")), F.min(F.size("a")), F.sum((~F.col("s").rlike("^[0-9A-Za-z]*$")).cast("int")),
    ).first()
    assert r[0] < -2e9 and r[1] > 2e9 and r[2] < -9e18 and r[3] > 9e18 and r[4] < -1.7e308 and r[5] > 1.7e308
    assert r[6] == 20 and r[7] == 0 and r[8] == 4 and r[9] == 0 and r[10] == 0


def test_generated_patches_always_apply(spark):
    from tarn.operators import patches as P

    schema = "a STRUCT<b: INT, c: ARRAY<STRUCT<d: STRING, e: ARRAY<DOUBLE>>>>, f TIMESTAMP, g ARRAY<ARRAY<INT>>"
    rows = generate.generate_rows(spark.range(300), schema, seed=1)
    made = generate.generate_patches(rows, schema, "id", seed=1)
    log = P.read_patch_log(made.withColumn("seq", F.lit(1).cast("bigint")), "id", "seq")
    assert P.patch_rejects(rows, log, schema, "id", "seq").count() == 0
    paths = {r["path"] for r in made.select("path").distinct().collect()}
    assert any(p.count("/") >= 5 for p in paths) and "/f" in paths


def put(doc, path, value):
    """Replace one place of a document; False if an index is out of range."""
    steps = [s.replace("~1", "/").replace("~0", "~") for s in path.split("/")[1:]]
    for s in steps[:-1]:
        if isinstance(doc, list) and int(s) >= len(doc):
            return False
        doc = doc[int(s) if isinstance(doc, list) else s]
    last = int(steps[-1]) if isinstance(doc, list) else steps[-1]
    if isinstance(doc, list) and last >= len(doc):
        return False
    doc[last] = value
    return True


@pytest.mark.parametrize("seed", range(4))
def test_several_generated_patches_equal_replay(spark, seed):
    from tarn.operators import patches as P

    schema = sample_schema(seed)
    rows = generate.generate_rows(spark.range(12), schema, seed=seed)
    made = generate.generate_patches(rows, schema, "id", n=12, seed=seed)
    log = P.read_patch_log(made.select("id", F.col("nth").cast("bigint").alias("seq"), "doc"), "id", "seq")
    assert log.count() == 12 * 12
    text = lambda df: {r["id"]: r["raw"] for r in project.to_json_docs(df, schema, keep=["id"]).collect()}
    documents = {k: json.loads(v) for k, v in text(rows).items()}
    refused = set()
    for r in sorted(made.collect(), key=lambda r: r["nth"]):
        if not put(documents[r["id"]], r["path"], json.loads(r["doc"])["value"]):
            refused.add((r["id"], r["nth"]))
    # Both sides through the same reader, so that numbers are written alike.
    replayed = spark.createDataFrame([(k, json.dumps(v)) for k, v in documents.items()], "id BIGINT, raw STRING")
    good, bad = split_valid(parse_docs(replayed), schema)
    assert bad.count() == 0
    log = P.judge_log(log, schema, "id", "seq")
    done = P.apply_patch_log(rows, log, schema, "id", "seq", judged=True)
    assert text(done) == text(project.to_rows(good, schema, keep=["id"]))
    got = P.patch_rejects(rows, log, schema, "id", "seq", judged=True).select("id", "seq").collect()
    assert {tuple(r) for r in got} == refused


def test_flatten_and_explode(spark):
    schema = "k INT, s STRUCT<a: INT, t: STRUCT<b: STRING>>, l ARRAY<STRUCT<x: INT, y: ARRAY<STRUCT<z: INT>>>>"
    raw = {"k": 1, "s": {"a": 2, "t": {"b": "q"}}, "l": [{"x": 3, "y": [{"z": 4}, {"z": 5}]}, {"x": 6, "y": []}]}
    docs = parse_docs(spark.createDataFrame([(json.dumps(raw),)], "raw STRING"))
    good, _ = split_valid(docs, schema)
    flat = project.flatten_paths(project.to_rows(good, schema), schema)
    assert flat.columns == ["k", "s_a", "s_t_b", "l_x", "l_y_z"]
    assert tuple(flat.first()) == (1, 2, "q", [3, 6], [[4, 5], []])
    nodes = project.explode_nodes(good.withColumn("id", F.lit(1)), schema, "id").collect()
    assert [(r["path"], r["type"], r["value"]) for r in nodes] == [
        ("/k", "integer", "1"), ("/s/a", "integer", "2"), ("/s/t/b", "string", "q"), ("/l/0/x", "integer", "3"),
        ("/l/0/y/0/z", "integer", "4"), ("/l/0/y/1/z", "integer", "5"), ("/l/1/x", "integer", "6"),
    ]
    with pytest.raises(SchemaError):
        project.flatten_paths(spark.sql("SELECT 1 AS a_b, named_struct('b', 1) AS a"), "a_b INT, a STRUCT<b: INT>")


def test_conform_table(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', 1, 'y', 'q') AS s, array(1) AS l")
    out = project.conform_table(df, "s STRUCT<y: STRING, x: BIGINT>, a BIGINT, l ARRAY<DOUBLE>")
    assert out.columns == ["s", "a", "l"]
    row = out.first()
    assert tuple(row["s"]) == ("q", 1) and row["a"] == 1 and row["l"] == [1.0]
    with pytest.raises(SchemaError) as e:
        project.conform_table(df, "a STRING, b INT, s STRUCT<x: INT>, l ARRAY<INT>")
    for part in ("/a: expected string", "/b: expected int, found missing", "/s/y: expected nothing"):
        assert part in str(e.value)


def test_shapes_ignore_order_and_share_records(spark):
    raws = ['{"a":{"x":1,"y":2.5},"b":[{"y":10.25,"x":7}]}', '{"b":[],"a":{"y":1.0,"x":2}}', "[1]", "nope", '{"b":[{"x":1,"y":1e3}],"a":{"x":1,"y":0.5}}']
    docs = parse_docs(spark.createDataFrame(list(enumerate(raws)), "k INT, raw STRING"))
    got = {r["shape"]: (r["n"], r["example"]) for r in shapes.shape_registry(docs, "k").collect()}
    assert got["OBJECT<a: OBJECT<x: BIGINT, y: DOUBLE>, b: ARRAY<OBJECT<x: BIGINT, y: DOUBLE>>>"] == (2, 0)
    assert len(got) == 3
    schema = "a STRUCT<x: INT, y: DOUBLE>, b ARRAY<STRUCT<x: INT, y: DOUBLE>>"
    nested = {r["shape"]: r for r in shapes.shape_registry_nested(docs, schema, "k").collect()}
    shared = nested["OBJECT<x: BIGINT, y: DOUBLE>"]
    assert (shared["n"], shared["n_paths"], shared["example_path"], shared["example"]) == (5, 2, "/a", 0)


def test_sorting(spark):
    values = [5, 3, 3, 9, -1, 3, 7] + [3] * 500
    df = spark.createDataFrame([(v,) for v in values], "v INT").repartition(3)
    done = order.sort_values(df, "v")
    assert [r["v"] for r in done.collect()] == sorted(values)
    # Small partitions would be merged again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    held = done.withColumn("p", F.spark_partition_id()).where("v = 3").select("p").distinct().count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert held > 1  # one value, several partitions
    lists = spark.createDataFrame([([12, 10, 1, 15, 10],), ([],)], "l ARRAY<INT>")
    assert [r["l"] for r in order.sort_arrays(lists, "l").collect()] == [[1, 10, 10, 12, 15], []]


def test_lake_tables(spark, tmp_path):
    text = tmp_path / "docs"
    spark.createDataFrame([('{"a": 1, "t": "x"}',), ('{"a": "no"}',), ("{",)], "value STRING").write.text(str(text))
    docs = read_json_docs(spark, str(text))
    assert docs.where("doc IS NULL").count() == 1
    schema = "a INT, t STRING"
    write_lake(docs, schema, str(tmp_path / "one"))
    assert [tuple(r) for r in read_lake(spark, str(tmp_path / "one")).collect()] == [(1, "x")]
    bad = read_lake(spark, str(tmp_path / "one"), valid=False).collect()
    assert sorted(r["_raw"] for r in bad) == ["{", '{"a": "no"}']
    write_lake(docs, schema, str(tmp_path / "good"), str(tmp_path / "bad"))
    assert [tuple(r) for r in read_parquet_as(spark, str(tmp_path / "good"), schema).collect()] == [(1, "x")]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2
    with pytest.raises(SchemaError):
        write_lake(docs, "a STRUCT<>", str(tmp_path / "none"))
    with pytest.raises(SchemaError):
        read_parquet_as(spark, str(tmp_path / "good"), "a DECIMAL(5,2)")
