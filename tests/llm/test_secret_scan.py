"""Secret scans against plain regular expressions and counts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tarn.llm import secret_scan as S

BASE = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 2, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}


def wanted(rows):
    """For each (doc_id, source, text): its spans with verdicts."""
    found = []
    for doc, source, text in rows:
        text, spans = text or "", []
        for n, (pattern, group, least) in enumerate(BASE.values()):
            spans += [(m.start(), n, m.end(), m[group]) for m in pattern.finditer(text) if len(m[group]) >= least]
        covered = {p for a, _, b, _ in spans for p in range(a, b)}
        for m in re.finditer("[A-Za-z0-9_-]{20,}", text):
            mixed = re.search("[A-Za-z]", m[0]) and len(re.findall("[0-9]", m[0])) >= 3
            if mixed and not covered & set(range(m.start(), m.end())):
                spans.append((m.start(), 3, m.end(), m[0]))
        found.append(spans)
    owners, repositories = {}, {}
    for (doc, source, _), spans in zip(rows, found):
        for *_, value in spans:
            owners.setdefault(value, set()).add(source)
            repositories.setdefault(value, set()).add(doc)
    live = lambda v: len(owners[v]) <= S.MOST_OWNERS and len(repositories[v]) <= S.MOST_REPOSITORIES
    kinds = [*BASE, "owned"]
    return [
        (doc, [(kinds[n], a, b, live(v)) for a, n, b, v in sorted(spans) if n < 3 or live(v)]) for (doc, _, _), spans in zip(rows, found)
    ]


def got(df):
    return sorted(((r["doc_id"], [tuple(s) for s in r["spans"]]) for r in df.collect()), key=repr)


def pieces():
    keys = ["password", "PassWd", "SECRET", "token", "Api_Key", "apikey", "to\u212aen", "\u017fecret", "pass"]
    marks = ["=", ": ", '" : "', " = \'", "==", "", ":=", "\n="]
    values = ["abc", "abcdef", "abcde\u00e9f", "token", "token:abcdefgh", "x/y+z_1.2-3==", "deadbeef" * 3, "DEADBEEF" * 3]
    alone = [
        "AKIA" + "A1" * 8, "AKIA" + "B2" * 7, "xAKIAAKIA" + "C3" * 9, "0123456789abcdef" * 2, "0123456789abcdef", "gh_" + "a1B2" * 6,
        "only-letters-in-a-long-run", "ab12" * 5 + "AKIA" + "9" * 16, "\U0001f600", "plain words", "e" * 24, "G" + "f0" * 13,
    ]
    return keys, marks, values, alone


def test_spans_and_verdicts_equal_brute_force(spark):
    rng, (keys, marks, values, alone) = random.Random(4), pieces()
    some = lambda: rng.choice([rng.choice(keys) + rng.choice(marks) + rng.choice(values), rng.choice(alone), f"zz{rng.randrange(80):04d}-{'q' * 16}"])
    texts = [rng.choice(["", " ", "\u00fc"]).join(some() for _ in range(rng.choice([0, 1, 4, 30]))) for _ in range(300)]
    rows = [(rng.choice([None, *range(250)]), rng.choice([None, "a", "b", "c", "d"]), t) for t in texts]
    rows += [(900, "a", None), (901, None, ""), (902, "b", "\u00e9 " * 200_000 + "token=" + "a1" * 20), rows[0], rows[0]]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, text STRING")
    clash = ["Spans", "_row", "kind", "hash", "n", "live", "_kept_0", "start"]
    frame = frame.select("*", *[F.lit("x").alias(c) for c in clash])
    made = S.scan(frame)
    assert made.columns == ["doc_id", "source", *clash[1:], "spans", "n_live", "n_example"]
    assert got(made) == sorted(wanted(rows), key=repr)
    assert got(S.scan(frame.limit(0))) == []


def test_copied_examples_and_own_credentials(spark):
    example, own, spread = "ex" + "4mpl3" * 5, "my" + "0wn8" * 6, "x9" + "Ab1" * 8
    rows = [(i, f"s{i % 10}", f"see {example} here") for i in range(40)]
    rows += [(100, "s1", f"use {own} now"), (101, "s1", f"use {own} again"), *[(200 + i, "s2", f"{spread}") for i in range(S.MOST_REPOSITORIES + 1)]]
    rows += [(300 + i, f"s{i}", 'TOKEN = "9233A8ECF7C5"') for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, text STRING")
    spans = dict(got(S.scan(frame)))
    assert spans[0] == [] and spans[200] == [] and spans[100] == [("owned", 4, 4 + len(own), True)]
    # Base spans stay, with the verdict.
    assert spans[300] == [("assign", 0, 21, False)]


@pytest.mark.parametrize("parts", [1, 10**9])
def test_frequent_values_take_either_way(spark, monkeypatch, parts):
    monkeypatch.setattr(S, "HOT_PARTS", parts)
    rows = [(i, f"s{i % (1 + i % 4)}", f"token=value{i % 3 * 11:03d} AKIA{'Z' * 16}{i % 50}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, text STRING")
    assert got(S.scan(frame)) == sorted(wanted(rows), key=repr)


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "a", "token=abcdef")], "doc_id BIGINT, source STRING, text STRING")
    plan = S.scan(frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|MapIn", plan)
