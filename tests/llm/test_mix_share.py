"""How much the mixture keeps is a parameter, not the rarest cell's by-product."""

import random

import pytest

import corpus_pipeline
from tarn.llm import mixing

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def kept_share(rows):
    return sum(r["p"] * r["n_tokens"] for r in rows) / sum(r["n_tokens"] for r in rows)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    return [
        (i, "w " * rng.randint(20, 60), rng.choice(["en", "en", "de", "fr", "es"]), rng.choice(["s0", "s0", "s0", "s1"]), 0)
        for i in range(4000)
    ]


def test_one_document_of_a_new_source_leaves_the_stage_alone(spark, rows):
    count = lambda r: corpus_pipeline.mix_stage(spark, spark.createDataFrame(r, DOCS), "").count()
    before, after = count(rows), count([*rows, (9999, "mail me @ home " * 12, "en", "new", 0)])
    assert 0.45 < before / len(rows) < 0.55
    assert abs(after - before) < 0.01 * len(rows)


@pytest.mark.parametrize("share", [0.1, 0.5, 1.0])
def test_expected_tokens_are_the_share(spark, rows, share):
    rare = [(9999, "mail me @ home", "en", "new", 0), (9998, None, "en", "none", 0)]
    got = mixing.mix(spark.createDataFrame(rows + rare, DOCS), share=share).collect()
    assert len(got) == len(rows) + 2 and all(0 < r["p"] <= 1 for r in got)
    assert kept_share(got) == pytest.approx(share, rel=1e-9)
    if share < 0.5:
        mass = {}
        for r in got:
            mass[r["lang"]] = mass.get(r["lang"], 0) + r["p"] * r["n_tokens"]
        assert [mass[x] / sum(mass.values()) for x in ("en", "de", "fr", "es")] == pytest.approx([0.5, 0.2, 0.2, 0.1], abs=0.01)


def test_shares_out_of_range_and_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows[:1], DOCS)
    assert mixing.mix(docs.limit(0), share=0.5).count() == 0
    for share in (0, 1.5):
        with pytest.raises(ValueError):
            mixing.mix(docs, share=share)
