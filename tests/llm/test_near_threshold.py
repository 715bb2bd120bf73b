"""The similarity of near duplicates is a parameter, and bands follow from it."""

import pytest

import corpus_pipeline
from tarn.llm import near_dup as N
from tests.llm.brute import shingles

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def planted():
    """Two texts of 100 shingles with 90 in common: 90 of 110, a similarity of 0.818."""
    words = [f"w{i}" for i in range(104)]
    a, b = " ".join(words), " ".join(words[:94] + [f"x{i}" for i in range(10)])
    one, two = shingles(a), shingles(b)
    assert 0.80 <= len(one & two) / len(one | two) < 0.85
    return [(1, a, "en", "s", 0), (2, b, "en", "s", 0), (3, "quite another text of its own", "en", "s", 0)]


def test_the_stage_links_a_pair_at_082(spark):
    docs = spark.createDataFrame(planted(), SCHEMA)
    assert {r["doc_id"] for r in corpus_pipeline.near_dup_stage(spark, docs, "").collect()} == {1, 3}
    assert {r["doc_id"] for r in N.keep_one(docs).collect()} == {1, 2, 3}


def test_bands_follow_the_similarity():
    assert N.bands_for(85) == (32, 6) and N.agree_for(85) == 0.72
    for similar in (30, 50, 80, 85, 95):
        bands, rows = N.bands_for(similar)
        assert bands * rows <= N.COORDINATES and (1 - (similar / 100) ** rows) ** bands < 1e-6
        assert N.agree_for(similar) < similar / 100
    for similar in (0, 101):
        with pytest.raises(ValueError):
            N.bands_for(similar)
