"""Nearest vectors: full numbers whatever the norms, the join by bucket, recall."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.llm import nearest as V
from tarn.llm import queries

SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>"


@pytest.fixture(scope="module")
def rows():
    x = np.random.default_rng(3).normal(size=(2000, 64))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return [(i, v.tolist()) for i, v in enumerate(x)]


def test_one_long_vector_leaves_no_query_short(spark, rows):
    long = (2000, [100 * c for c in rows[0][1]])
    got = V.nearest(spark.createDataFrame([*rows, long], SCHEMA), F.col("id") % 5 == 0).collect()
    assert Counter(r["query_id"] for r in got) == {i: 20 for i in range(0, 2001, 5)}


def test_short_queries_are_compared_with_all(spark, rows, monkeypatch):
    monkeypatch.setattr(V, "_visits_needed", lambda *a: 1)
    got = V.nearest(spark.createDataFrame(rows[:21], SCHEMA), F.col("id") % 4 == 0).collect()
    x = np.array([v for _, v in rows[:21]])
    for q in range(0, 21, 4):
        own = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
        best = [i for i in np.argsort(-V.exact(x[q], x), kind="stable").tolist() if i != q][:20]
        assert own == list(enumerate(best, 1))


def test_an_id_with_many_vectors_hides_no_other(spark, rows):
    near = np.array(rows[0][1])
    many = [(7000, (near * (1 + k / 100)).tolist()) for k in range(60)]
    got = V.nearest(spark.createDataFrame([*rows[:100], *many], SCHEMA), F.col("id") == 0).collect()
    assert len({r["vec_id"] for r in got}) == len(got) == 20


def test_visits_follow_each_query():
    assert V._reach([V._reach([1] * 20)] * 9 + [V._reach([1] * 18 + [900, 950])]) == 900


def test_a_join_by_bucket_finds_what_all_blocks_find(spark, rows, monkeypatch):
    """Bucket sizes here go from one to a third of all vectors."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 1500)] + rng.normal(size=(1500, 16)) * 0.02
    x[:500] = centres[0] + rng.normal(size=(500, 16)) * 0.01
    made = [(i, v.tolist()) for i, v in enumerate(x)]
    # Equal vectors of many ids, an id with two vectors, and rows that take no part.
    made += [(3000 + i, made[0][1]) for i in range(60)] + [(10, made[1499][1]), (4000, None), (4005, [0.0] * 16)]
    vectors = spark.createDataFrame(made, SCHEMA)
    found, asked = {}, F.col("id") % 5 == 0
    for part, tile, block in ((0.0, 1 << 19, 1024), (float("inf"), 1 << 19, 1024), (float("inf"), 1, 16)):
        monkeypatch.setattr(V, "LOOKUP_PART", part)
        monkeypatch.setattr(V, "TILE_VALUES", tile)
        monkeypatch.setattr(V, "BLOCK_QUERIES", block)
        got = V.nearest(vectors, asked, k=5).collect()
        found[part, tile] = sorted(map(tuple, got))
    whole, joined, cut = found.values()
    assert len(whole) == 5 * len({i for i, v in made if i % 5 == 0 and v and any(v)})
    assert joined == whole and cut == whole


def test_large_norms_lose_no_neighbour(spark):
    """Products far smaller than the norms' product, which single precision blurs."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8)) * 1e4
    x[:, 0] = rng.permutation(400) * 1e-4
    x[0] = [1e-3, *[0.0] * 7]
    x[1] = [*[0.0] * 7, 1e160]
    q, ids = x[0], [[i] for i in range(400)]
    at = np.arange(1, 400)
    got = V._best(0, q, x, V._single(x), at, ids, 20)
    best = sorted(((-s, i) for s, i in zip(V.exact(q, x).tolist(), range(400)) if i), key=lambda r: r)[:20]
    assert [i for i, _ in got] == [i for _, i in best]


def test_recall_of_the_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in table]), np.array([r["embedding"] for r in table], float)
    got: dict = {}
    for r in queries.op7_nearest(spark, sf).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for i in np.flatnonzero(ids % 20 == 0):
        s = V.exact(x[i], x)
        best = [j for j in np.lexsort((ids, -s)) if j != i][:20]
        recall.append(len(got[ids[i]] & set(ids[best].tolist())) / len(best))
    assert np.mean(recall) >= 0.95
