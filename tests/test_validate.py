import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.operators import project
from tarn.operators.validate import decode, error_report, first_incompatibility, parse_docs, split_valid, validate
from tarn.plans.schema import SchemaError, check_schema, node_tree


def docs(spark, *raws):
    rows = [(i, r if r is None or isinstance(r, str) else json.dumps(r)) for i, r in enumerate(raws)]
    return parse_docs(spark.createDataFrame(rows, "k INT, raw STRING"))


def errors(spark, schema, *raws):
    checked = validate(docs(spark, *raws), schema).select("k", "errors").collect()
    found = {r["k"]: [(e["path"], e["code"]) for e in r["errors"]] for r in checked}
    return [found[i] for i in range(len(raws))]


def test_flat_record(spark):
    good, bad = split_valid(docs(spark, '{"a": "heron", "b": 31}'), "a STRING, b INT")
    row = project.to_rows(good, "a STRING, b INT").first()
    assert tuple(row) == ("heron", 31) and bad.count() == 0
    back = project.to_json_docs(project.to_rows(good, "a STRING, b INT"), "a STRING, b INT").first()["raw"]
    assert json.loads(back) == {"a": "heron", "b": 31}


def test_nested_record(spark):
    schema = "a STRING, b STRUCT<c: INT>"
    good, _ = split_valid(docs(spark, '{"a": "heron", "b": {"c": 31}}'), schema)
    row = project.to_rows(good, schema).first()
    assert row["a"] == "heron" and tuple(row["b"]) == (31,)


@pytest.mark.parametrize(
    "dtype,value,code",
    [
        ("INT", "12", None), ("INT", "12.0", "type"), ("INT", "1e2", "type"), ("INT", "1.5", "type"),
        ("INT", "true", "type"), ("INT", '"1"', "type"), ("INT", "3000000000", "range"), ("INT", "-2147483648", None),
        ("INT", "18446744073709551615", "range"), ("INT", "null", "null"),
        ("BIGINT", "3000000000", None), ("BIGINT", "9223372036854775808", "range"), ("BIGINT", "12.0", "type"),
        ("DOUBLE", "1", None), ("DOUBLE", "1.5", None), ("DOUBLE", "1e400", "range"), ("DOUBLE", '"1"', "type"),
        ("DOUBLE", "123456789012345678901234567890123456789012345678901234567890", None),
        ("FLOAT", "1e300", "range"), ("FLOAT", "3.4e38", None), ("FLOAT", "-1e39", "range"), ("FLOAT", "false", "type"),
        ("STRING", '"x"', None), ("STRING", "5", "type"), ("STRING", '""', None), ("STRING", "{}", "type"),
        ("BOOLEAN", "true", None), ("BOOLEAN", "1", "type"), ("BOOLEAN", '"true"', "type"),
        ("TIMESTAMP", '"2020-01-01"', None), ("TIMESTAMP", '"2020-01-01T10:00"', None),
        ("TIMESTAMP", '"2020-01-01T10:00:00.123456Z"', None), ("TIMESTAMP", '"2020-01-01T10:00+02:00"', None),
        ("TIMESTAMP", '"T10:00"', "date_format"), ("TIMESTAMP", '"2020-01"', "date_format"),
        ("TIMESTAMP", '"2020-02-30"', "date_format"), ("TIMESTAMP", '"2020-01-01 10:00"', "date_format"),
        ("TIMESTAMP", "5", "type"), ("DATE", '"2020-01-01T23:59Z"', None), ("DATE", '"x"', "date_format"),
        ("STRUCT<>", "{}", None), ("STRUCT<>", '{"a":1}', None), ("STRUCT<>", "[]", "type"), ("STRUCT<>", "null", "null"),
        ("ARRAY<INT>", "[]", None), ("ARRAY<INT>", "[1,2]", None), ("ARRAY<INT>", "{}", "type"), ("ARRAY<INT>", '"a"', "type"),
    ],
)
def test_rules(spark, dtype, value, code):
    wanted = [] if code is None else [("/v", code)]
    assert errors(spark, f"v {dtype}", f'{{"v":{value}}}') == [wanted]


def test_all_errors_in_schema_order(spark):
    schema = "id INT, user STRUCT<id: INT, name: STRING>, items ARRAY<STRUCT<p: INT, q: STRING>>, big BOOLEAN"
    found = errors(
        spark,
        schema,
        {"id": 1, "user": {"id": 1, "name": "n"}, "items": [], "big": True, "more": [1]},
        {"user": {"id": "x"}, "items": [{"p": 1, "q": "a"}, {"p": "no"}, 5, None], "big": 1},
        {"id": 1, "user": 5, "items": {"p": 1}, "big": None},
        {"id": 1, "user": None, "items": [[]], "big": True},
        {},
        "[1]",
        "7",
        "not json",
        '{"id": 1, "id": 2}',
        None,
    )
    assert found[0] == []
    assert found[1] == [
        ("/id", "required"), ("/user/id", "type"), ("/user/name", "required"), ("/items/1/p", "type"),
        ("/items/1/q", "required"), ("/items/2", "type"), ("/items/3", "null"), ("/big", "type"),
    ]
    assert found[2] == [("/user", "type"), ("/items", "type"), ("/big", "null")]
    assert found[3] == [("/user", "null"), ("/items/0", "type")]
    assert found[4] == [("/id", "required"), ("/user", "required"), ("/items", "required"), ("/big", "required")]
    assert found[5] == [("", "type")] and found[6] == [("", "type")]
    assert found[7] == found[8] == found[9] == [("", "malformed")]


def test_nested_arrays(spark):
    schema = "m ARRAY<ARRAY<INT>>, d ARRAY<STRUCT<e: ARRAY<STRUCT<f: BOOLEAN>>>>"
    found = errors(
        spark, schema,
        {"m": [[1], [2, "x"], 3], "d": [{"e": [{"f": True}, {"f": 0}]}, {"e": 1}]},
        {"m": [[]], "d": []},
    )
    assert found == [[("/m/1/1", "type"), ("/m/2", "type"), ("/d/0/e/1/f", "type"), ("/d/1/e", "type")], []]


def test_roots_that_are_not_structs(spark):
    assert errors(spark, T.IntegerType(), "5", '"5"') == [[], [("", "type")]]
    assert errors(spark, T.ArrayType(T.IntegerType()), "[1]", '["a"]', "1") == [[], [("/0", "type")], [("", "type")]]
    five = decode(docs(spark, "5"), T.IntegerType())
    assert tuple(project.to_rows(five, T.IntegerType()).first()) == (5,)
    many = decode(docs(spark, "[1,2]"), T.ArrayType(T.IntegerType()))
    assert project.to_rows(many, T.ArrayType(T.IntegerType())).first()["value"] == [1, 2]


def test_awkward_field_names(spark):
    schema = T.StructType(
        [T.StructField(n, T.StructType([T.StructField("x", T.IntegerType())])) for n in ("a.b", "it's", 'q"q', "s/t~u", "`b`")]
    )
    good = {f.name: {"x": 1} for f in schema.fields}
    bad = {f.name: {"x": "no"} for f in schema.fields}
    worse = {f.name: 1 for f in schema.fields}
    found = errors(spark, schema, good, bad, worse)
    paths = ["/a.b", "/it's", '/q"q', "/s~1t~0u", "/`b`"]
    assert found[0] == []
    assert found[1] == [(p + "/x", "type") for p in paths]
    assert found[2] == [(p, "type") for p in paths]
    rec = split_valid(docs(spark, good), schema)[0]
    assert [r["x"] for r in project.to_rows(rec, schema).first()] == [1] * 5


def test_time_zones_do_not_matter(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        schema = "at TIMESTAMP, day DATE"
        good, _ = split_valid(docs(spark, '{"at": "2020-01-01T01:00", "day": "2020-01-01T23:00-05:00"}'), schema)
        row = good.select(F.unix_millis("rec.at").alias("ms"), F.col("rec.day").cast("string").alias("day"))
        assert tuple(row.first()) == (1577840400000, "2020-01-02")
        avro = project.avro_layout(project.to_rows(good, schema), schema).first()
        assert tuple(avro) == (1577840400000, 1577923200000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_reports(spark):
    schema = "a INT, l ARRAY<INT>"
    d = docs(spark, {"a": 1, "l": [1, "x", "y"]}, {"l": ["z"]}, {"a": 1, "l": []})
    got = {(r["path"], r["code"]): (r["n"], r["example"]) for r in error_report(d, schema, "k").collect()}
    assert got == {("/l/*", "type"): (3, 0), ("/a", "required"): (1, 1)}
    first = {r["k"]: tuple(r)[1:] for r in first_incompatibility(d, schema, "k").collect()}
    assert first == {0: ("/l/1", "integer", "STRING"), 1: ("/a", "integer", "MISSING")}


def test_bad_schemas_are_refused(spark):
    for bad in ("a MAP<STRING, INT>", "a STRUCT<b: DECIMAL(3,1)>", "a ARRAY<BINARY>", "a INT, A INT"):
        with pytest.raises(SchemaError):
            check_schema(bad)
    both = T.StructType([T.StructField("x'y\"", T.IntegerType())])
    with pytest.raises(SchemaError):
        check_schema(both)


def test_node_numbers(spark):
    root = node_tree(check_schema("a STRUCT<b: INT, c: ARRAY<INT>>, d INT"))
    assert [(n.id, n.path, n.end) for n in root.walk()] == [
        (0, "", 5), (1, "/a", 4), (2, "/a/b", 2), (3, "/a/c", 4), (4, "/a/c/~i", 4), (5, "/d", 5),
    ]


def test_no_python_in_the_plan(spark):
    plan = decode(docs(spark, "{}"), "a INT, b ARRAY<STRUCT<c: TIMESTAMP>>")._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
    assert plan.count("parseJson") <= 1
