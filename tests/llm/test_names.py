"""Columns that only pass through keep their values, whatever their names."""

import pytest
from pyspark.sql import functions as F

from tarn.llm import decontaminate, language, language_model, line_dedup, mixing, near_dup, quality, sharding

HELPERS = (
    "_kept_0 _kept_2 _text_hash _hash _id comp node bucket _shard_hash _shard_row _entry _full _p fine _mix_p topic_ own tokens"
    " _text_key _first _words _now _gone _f _full_gone _guess lang_pred score predicted _quality_stats _learn _y _hit_from n_words"
    " shard depth shard_bytes n_tokens p kept n_lines n_runs"
).split()
#: What each operator replaces.
ADDED = {
    "near": (), "clean": (), "good": (), "shard": ("shard", "depth", "shard_bytes"), "mix": ("n_tokens", "p", "kept"),
    "lines": ("n_lines", "n_deleted", "n_runs"), "language": ("lang_pred", "score"), "quality": ("score", "predicted"),
}
ROWS = [(1, "some plain words here", "en", "s"), (2, None, "en", None), (None, "", None, "s"), (4, "word " * 100_000, "de", "t")]


@pytest.fixture(scope="module")
def docs(spark):
    own = spark.createDataFrame(ROWS, "doc_id BIGINT, text STRING, lang STRING, source STRING")
    return own.select("*", *[F.concat(F.lit(f"{h}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(h) for h in HELPERS])


@pytest.mark.parametrize("operator", list(ADDED))
def test_passing_columns_keep_their_values(spark, docs, operator):
    labels = spark.createDataFrame([(1, 1, "x")], "doc_id BIGINT, quality INT, score STRING")
    items = spark.createDataFrame([(1, "never seen item", "x")], "item_id BIGINT, text STRING, window STRING")
    made = {
        "near": lambda: near_dup.keep_one(docs),
        "clean": lambda: decontaminate.clean(docs, items),
        "good": lambda: quality.keep_good(docs, labels, F.lit(True)),
        "shard": lambda: sharding.shard(docs, 100),
        "mix": lambda: mixing.mix(docs, {"source": 0.5, "lang": 0.5}),
        "lines": lambda: line_dedup.dedup_lines(docs),
        "language": lambda: language.identify(docs, language.learn(docs, F.lit(True))),
        "quality": lambda: quality.score_documents(docs, labels, F.lit(True)),
    }[operator]()
    got = made.collect()
    assert len(got) == len(ROWS)
    for r in got:
        own = "-" if r["doc_id"] is None else str(r["doc_id"])
        assert all(r[h] == f"{h}:{own}" for h in HELPERS if h not in ADDED[operator])


def test_long_texts_are_scored_whole(spark):
    rows = [(1, "a b " * 200_000), (2, "a b")]
    got = language_model.score_documents(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), F.col("doc_id") == 2).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["n_known"]) for r in got} == {1: (400_001, 400_001), 2: (3, 3)}


def test_a_window_of_many_items_is_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 40)
    items = spark.range(100).select(F.col("id").alias("item_id"), F.lit("shared item text").alias("text"))
    docs = spark.createDataFrame([(1, "a shared item text"), (2, "clean")], "doc_id BIGINT, text STRING")
    got = {r["doc_id"]: r for r in decontaminate.scan(docs, items).collect()}
    assert got[1]["n_hit"] == 3 and got[1]["items"] == sorted(str(i) for i in range(100)) and got[2]["n_items"] == 0
