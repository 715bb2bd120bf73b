"""Repair of conversations against a plain search over all edits."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tarn.llm import conversation_repair as C
from tarn.llm import queries
from tests.llm.brute import damage, repaired

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def wanted(rows, ids):
    by = {}
    for conv, *rest in rows:
        by.setdefault(conv, []).append(tuple(rest))
    out = []
    for conv in ids:
        *numbers, text = repaired(by.get(conv, []))
        out.append((conv, *numbers, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in queries.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op13_conversation_repair(spark, sf)) == wanted(damage(rows), {r[0] for r in rows})


def test_odd_rows(spark):
    rng = random.Random(7)
    texts = ["Yes.", "No", "ok?", "", " ", "\t\n", None, "Hm!  ", "\u00e9.\u00a0", "x" * 300_000 + "."]
    roles = ["user", "assistant", "system", "tool", "User", "", None, "u", "\U0001f600"]
    rows = [
        (rng.choice([None, *range(60)]), rng.choice([None, *range(9)]), rng.choice(roles[: rng.choice([3, 9])]), rng.choice(texts[: rng.choice([3, 10])]))
        for _ in range(500)
    ]
    rows += [(70, 1, "user", "Hi."), (70, 1, "user", "Hi."), (71, None, None, None), (72, 2**62, "user", "Hi."), (72, -(2**62), "assistant", "Hi.")]
    clash = ["audit", "_row", "_h", "codes", "edit", "_part"]
    frame = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in clash])
    assert got(C.report(frame)) == wanted(rows, {r[0] for r in rows})
    ids = [(None,), (5,), (900,)]
    assert got(C.report(frame.where("conv_id = 5"), spark.createDataFrame(ids, "conv_id BIGINT"))) == wanted(
        [r for r in rows if r[0] == 5], [None, 5, 900]
    )
    assert got(C.report(frame.limit(0))) == []


def test_one_busy_conversation_over_many_parts(spark):
    rng = random.Random(3)
    rows = [(i % 3 and 1, i % 700, rng.choice(["user", "assistant"]), rng.choice(["a.", "b.", f"{i}.", str(i)])) for i in range(3000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        judged = C._judged(C._prepared(frame))
        assert judged.where("conv_id = 1").select("_part").distinct().count() > 1
        assert got(C.report(frame)) == wanted(rows, {0, 1})
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_the_repaired_turns_follow_the_grammar(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "tool", "42."), (1, 3, "user", "cut off")]
    frame = spark.createDataFrame(rows, SCHEMA)
    turns = C.repair(frame, C.audits(frame)).orderBy("seq").collect()
    assert [(r["edit"], r["role"], r["text"]) for r in turns] == [
        ("K", "system", "Be brief."), ("I", "user", ""), ("K", "assistant", "Hello."), ("R", "user", "42."), ("R", "assistant", "cut off")
    ]


@pytest.mark.parametrize("n", [400, 3000])
def test_long_conversations(n):
    rng = random.Random(n)
    codes = "".join(rng.choice("EIEIEIABCDMNOP") for _ in range(n))
    rows = {"A": "system", "E": "user", "I": "assistant", "M": "tool"}
    turns = []
    for i, c in enumerate(codes):
        role, fault = rows["AEIM"[(ord(c) - 65) // 4]], (ord(c) - 65) % 4
        # Duplicates are met as blank rows: both must go.
        turns.append((i, role, "" if fault > 1 else f"{i}" + ("" if fault else ".")))
    *_, cost, audit, _ = repaired(turns)
    assert C.least_audit(codes) == (cost, audit)
