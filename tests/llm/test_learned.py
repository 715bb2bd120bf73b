"""Operators that learn: quality, language and the language model."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarn.llm import language as L
from tarn.llm import language_model as M
from tarn.llm import quality as Q
from tarn.llm import queries
from tests.llm.brute import cut, token_counts

SF = "/root/testdata/sf0.01"


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_rules_find_a_conjunction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(Q.STATS)))
    y = ((x[:, 2] > 0.6) & (x[:, 5] <= 0.4)).astype(float)
    model = Q.fit(x, y)
    total = np.full(len(x), model.bias)
    for rule in model.rules:
        total += rule.weight * Q._holds(x, rule.tests)
    assert ((total > 0) == (y == 1)).mean() > 0.98
    assert len(model.rules) < 120


def test_quality_of_held_out_rows(spark):
    got = {r["doc_id"]: r for r in queries.op2_quality(spark, SF).collect()}
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if fold(r["doc_id"], 3) == 1]
    assert len(labels) > 100 and len(got) == 1000
    assert np.mean([got[r["doc_id"]]["predicted"] == r["quality"] for r in labels]) > 0.95
    assert all(r["held_out"] == (fold(d, 3) == 1) and 0 <= r["score"] <= 1 for d, r in got.items())


def test_quality_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (3, "x " * 300_000, "c"), (3, "ok", "d"), (None, "fine words here.", "e")],
        "doc_id BIGINT, text STRING, score STRING",
    )
    none = spark.createDataFrame([], "doc_id BIGINT, quality INT, words STRING")
    rows = Q.score_documents(docs, none, F.lit(True)).collect()
    assert len(rows) == 5 and all(r["score"] == 0.5 for r in rows)
    one = spark.createDataFrame([(3, 1, ""), (1, None, "")], "doc_id BIGINT, quality INT, words STRING")
    assert all(r["predicted"] == 1 for r in Q.score_documents(docs, one, F.lit(True)).collect())
    assert Q.keep_good(docs, one, F.lit(True)).columns == docs.columns
    assert Q.keep_good(docs.limit(0), one, F.lit(True)).count() == 0


def test_statistics_of_empty_and_odd_texts():
    made = Q.text_stats(pa.array(["", None, "A A b!!", "x"]))
    assert [made[s][0] for s in Q.STATS] == [made[s][1] for s in Q.STATS] == [0] * len(Q.STATS)
    assert made["repeat"][2] == pytest.approx(1 / 3) and made["distinct"][2] == pytest.approx(2 / 3)


def test_language_of_held_out_rows(spark):
    got = {r["doc_id"]: r for r in queries.op6_language(spark, SF).collect()}
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if fold(r["doc_id"], 5) == 0]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in docs]) > 0.95


def test_language_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, "en", 1), (2, "", "en", 1), (3, "12 !?", "en", 1), (4, "words and more words", "en", 1), (4, "é" * 9000, None, 1)],
        "doc_id BIGINT, text STRING, lang STRING, n INT",
    )
    net = L.learn(docs, F.lit(True))
    rows = [(r["lang_pred"], r["score"]) for r in L.identify(docs, net).orderBy("doc_id").collect()]
    assert rows[:3] == [("und", 0.0)] * 3 and all(r == ("en", 1.0) for r in rows[3:])
    assert L.learn(docs.limit(0), F.lit(True)) is None
    assert {r["lang_pred"] for r in L.identify(docs, None).collect()} == {"und"}


def test_every_window_of_a_text_votes():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.choice(list(kind), 200)).decode() for kind in (b"abcd", b"wxyz") for _ in range(150)]
    net = L.train(L.to_windows([t.encode() for t in texts]), np.repeat([0, 1], 150), ["low", "high"])
    best, _ = L.judge(net, net.tables(), pa.array(["ab" * 300 + "wxyz" * 600, "abcd" * 600 + "wx" * 100, "", None]))
    assert best[:2].tolist() == [1, 0]


def test_model_counts_and_scores(spark):
    rows = [(1, "The cat sat"), (2, "the cat ran"), (3, None), (4, ""), (5, "the  dog\tsat \n the cat sat"), (5, "cat"), (6, "new words é"), (None, "the cat")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id BIGINT, text STRING, chunk INT")
    held = F.col("doc_id").isin(2, 6)
    got = sorted(M.score_documents(docs, held).collect(), key=lambda r: (r["doc_id"] or 0, r["n_tokens"]))
    counts = token_counts([t for d, t in rows if d not in (2, 6)])
    n, v = sum(counts.values()), len(counts)
    for r, (d, t) in zip(got, sorted(rows, key=lambda x: (x[0] or 0, len(cut(x[1]))))):
        tokens = [*cut(t), None]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        assert (r["doc_id"], r["n_tokens"], r["train_tokens"]) == (d, len(tokens), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens) and r["held_out"] == (d in (2, 6))
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert M.score_documents(docs.limit(0), held).count() == 0
    assert all(r["n_known"] == 0 for r in M.score_documents(docs, F.lit(True)).collect())


def test_chunks_do_not_change_scores(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    read = lambda: {r["doc_id"]: r["score"] for r in M.score_documents(docs, F.col("doc_id") % 5 == 1).collect()}
    whole = read()
    monkeypatch.setattr(M, "RANGE_ENTRIES", 900)
    parts = read()
    assert all(whole[d] == pytest.approx(parts[d]) for d in whole)


def test_weights_follow_the_likelier_estimate():
    step = lambda p: int(M._steps(np.array([p]))[0])
    cell = lambda b, pair, single: (b * M._STEPS + step(pair)) * M._STEPS + step(single)
    cells = np.array([cell(3, 0.5, 0.01), cell(5, 0.0, 0.2)])
    weights = M.learn_weights(cells, np.array([1000.0, 1000.0]), 1e-6)
    assert np.allclose(weights.sum(axis=1), 1) and weights[3, 0] > 0.95 and weights[5, 1] > 0.95
