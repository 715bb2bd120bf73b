import json
import random

import pytest
from pyspark.sql import functions as F

from tarn.operators import patches as P
from tests.replay import replay

SCHEMA = (
    "foo STRUCT<bar: INT, baz: BOOLEAN>, qux STRING, "
    "nums ARRAY<INT>, rows ARRAY<STRUCT<a: INT, deep: ARRAY<INT>>>, `x/y~z` INT, `7` INT"
)


def fits(kind, v):
    if kind == "int":
        return type(v) is int and -(2**31) <= v < 2**31
    if kind == "bool":
        return type(v) is bool
    if kind == "str":
        return type(v) is str
    if isinstance(kind, list):
        return type(v) is list and all(fits(kind[0], x) for x in v)
    return type(v) is dict and all(k in v and fits(t, v[k]) for k, t in kind.items())


ROW = {"a": "int", "deep": ["int"]}
KIND = {
    "foo": {"bar": "int", "baz": "bool"},
    "qux": "str",
    "nums": ["int"],
    "rows": [ROW],
    "x/y~z": "int",
    "7": "int",
}


def types_at(steps):
    kind = KIND
    for s in steps:
        s = s.replace("~1", "/").replace("~0", "~")
        if isinstance(kind, dict) and s in kind:
            kind = kind[s]
        elif isinstance(kind, list) and s.isdigit() and (s == "0" or s[0] != "0"):
            kind = kind[0]
        else:
            return None
    return kind



def value_for(rng, kind, bad):
    if bad:
        return {"int": "no", "bool": 1, "str": 5}.get(kind if isinstance(kind, str) else "", None)
    if kind == "int":
        return rng.randint(-99, 99)
    if kind == "bool":
        return rng.random() < 0.5
    if kind == "str":
        return f"s{rng.randint(0, 99)}"
    if isinstance(kind, list):
        return [value_for(rng, kind[0], False) for _ in range(rng.randint(0, 4))]
    return {k: value_for(rng, t, False) for k, t in kind.items()}


PATHS = [
    "", "/foo", "/foo/bar", "/foo/baz", "/qux", "/nums", "/nums/0", "/nums/2", "/nums/3", "/rows", "/rows/0",
    "/rows/1", "/rows/2/a", "/rows/0/a", "/rows/1/deep", "/rows/0/deep/0", "/rows/1/deep/2", "/rows/3/deep/1",
    "/7", "/nope", "/nums/-", "/nums/01", "/foo/bar/0", "/nums/99999999999999999999", "nums", "/rows/0/deep/x",
]


def make_log(seed, n_keys=6, n=400, hot=False):
    rng = random.Random(seed)
    entities = {k: value_for(rng, KIND, False) for k in range(n_keys)}
    log = []
    for seq in range(n):
        key = 0 if hot and rng.random() < 0.5 else rng.randint(0, n_keys)  # n_keys itself is unknown
        path = rng.choice(PATHS)
        if path == "" and rng.random() < 0.7:
            path = "/rows"
        kind = types_at(path.split("/")[1:] if path else []) or "int"
        bad = rng.random() < 0.1
        op = "replace" if rng.random() < 0.95 else rng.choice(["add", "remove"])
        log.append((key, seq, op, path, value_for(rng, kind, bad)))
    return entities, log


def to_frames(spark, entities, log):
    from tarn.operators.validate import parse_docs, split_valid

    rows = [(k, json.dumps(v)) for k, v in entities.items()]
    good, _ = split_valid(parse_docs(spark.createDataFrame(rows, "k BIGINT, raw STRING")), SCHEMA)
    e = good.select("k", "rec.*")
    docs = [(k, s, json.dumps({"op": op, "path": p, "value": v})) for k, s, op, p, v in log]
    d = spark.createDataFrame(docs, "k BIGINT, seq BIGINT, doc STRING").repartition(4)
    return e, P.read_patch_log(d, "k", "seq")


def state_of(df):
    text = df.select("k", F.to_json(F.struct(*[f"`{c}`" for c in df.columns if c not in ("k", "last_seq")])).alias("j"))
    return {r["k"]: json.loads(r["j"]) for r in text.collect()}


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True), (3, False)])
def test_log_equals_one_by_one_replay(spark, seed, hot):
    entities, log = make_log(seed, hot=hot)
    e, p = to_frames(spark, entities, log)
    wanted, refused = replay(entities, log, fits, types_at)
    assert state_of(P.apply_patch_log(e, p, SCHEMA, "k", "seq")) == wanted
    got = P.patch_rejects(e, p, SCHEMA, "k", "seq").select("k", "seq", "code").collect()
    assert sorted(tuple(r) for r in got) == sorted(refused)


def test_escaped_and_numeric_field_names(spark):
    entities = {1: value_for(random.Random(5), KIND, False)}
    log = [
        (1, 1, "replace", "/x~1y~0z", 11),
        (1, 2, "replace", "/7", 12),
        (1, 3, "replace", "/8", 12),
        (1, 4, "replace", "/x~2", 12),
        (1, 5, "replace", "/nums/~i", 12),
        (1, 6, "replace", "/x/y~0z", 12),
    ]
    e, p = to_frames(spark, entities, log)
    state = state_of(P.apply_patch_log(e, p, SCHEMA, "k", "seq"))[1]
    assert (state["x/y~z"], state["7"]) == (11, 12)
    got = P.patch_rejects(e, p, SCHEMA, "k", "seq").select("seq", "code").collect()
    assert sorted(tuple(r) for r in got) == [(s, "invalid_path") for s in (3, 4, 5, 6)]


def test_replace_one_field(spark):
    schema = "foo STRUCT<bar: INT, baz: BOOLEAN>, qux STRING"
    e = spark.sql("SELECT 1 AS k, named_struct('bar', 1, 'baz', true) AS foo, 'hoay!' AS qux")
    got = P.apply_patch(e, "/foo/bar", "42", schema).first()
    assert (got["foo"]["bar"], got["foo"]["baz"], got["qux"], got["patch_code"]) == (42, True, "hoay!", None)
    assert P.apply_patch(e, "/foo/bar", '"x"', schema).first()["patch_code"] == "invalid_patch"
    assert P.apply_patch(e, "/foo/no", "1", schema).first()["patch_code"] == "invalid_path"
    assert P.apply_patch(e, "/foo/bar", "1", schema, op="add").first()["patch_code"] == "unsupported_op"


def test_one_patch_on_arrays_of_each_entity(spark):
    schema = "rows ARRAY<STRUCT<a: INT>>"
    e = spark.sql(
        "SELECT 1 AS k, array(named_struct('a', 1), named_struct('a', 2)) AS rows "
        "UNION ALL SELECT 2, array(named_struct('a', 1))"
    )
    got = {r["k"]: ([x["a"] for x in r["rows"]], r["patch_code"]) for r in P.apply_patch(e, "/rows/1/a", "9", schema).collect()}
    assert got == {1: ([1, 9], None), 2: ([1], "invalid_path")}


def test_missing_value_null_value_and_error_paths(spark):
    docs = spark.createDataFrame(
        [
            (1, 1, '{"op":"replace","path":"/foo"}'),
            (1, 2, '{"op":"replace","path":"/foo/bar","value":null}'),
            (1, 3, '{"op":"replace","path":"/foo","value":{"bar":"x"}}'),
            (1, 4, "not json"),
            (1, 5, '{"op":5,"path":"/foo/bar","value":1}'),
            (1, 6, '{"op":"replace","path":"/foo/no/deeper","value":1}'),
        ],
        "k BIGINT, seq BIGINT, doc STRING",
    )
    checked = P.validate_patches(P.read_patch_log(docs, "k", "seq"), SCHEMA)
    got = {
        r["seq"]: (r["code"], [(e["path"], e["code"]) for e in r["errors"]], r["depth"])
        for r in checked.select("seq", "code", "errors", "depth").collect()
    }
    assert got[1] == ("invalid_patch", [("/foo", "required")], 1)
    assert got[2] == ("invalid_patch", [("/foo/bar", "null")], 2)
    assert got[3] == ("invalid_patch", [("/foo/bar", "type"), ("/foo/baz", "required")], 1)
    assert got[4][0] == "malformed" and got[5][0] == "unsupported_op"
    assert (got[6][0], got[6][2]) == ("invalid_path", 1)


def test_duplicate_seqs(spark):
    p = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (1, 2)], "k BIGINT, seq BIGINT")
    assert [tuple(r) for r in P.duplicate_seqs(p, "k", "seq").collect()] == [(1, 1, 2)]


def test_compaction_bounds_what_is_gathered(spark):
    """Index patches far outside an array never reach the entity's row."""
    entities = {1: value_for(random.Random(1), KIND, False)}
    log = [(1, s, "replace", f"/nums/{100 + s}", s) for s in range(300)]
    e, p = to_frames(spark, entities, log)
    row = P.attach_patches(e, p, SCHEMA, "k", "seq").first()
    assert row["patches"] is None
    assert P.patch_rejects(e, p, SCHEMA, "k", "seq").count() == 300


def test_no_python_in_the_plan(spark):
    entities, log = make_log(4, n=20)
    e, p = to_frames(spark, entities, log)
    plan = P.apply_patch_log(e, p, SCHEMA, "k", "seq")._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
