import corpus_pipeline as C
from tests.llm.brute import contamination, near_components

SF = "/root/testdata/sf0.001"


def test_stages_follow_their_contracts(spark):
    docs = C.table(spark, SF, "documents")
    items = [tuple(r) for r in C.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    seen = {}
    for name, stage in C.STAGES:
        docs = C.staged(stage(spark, docs, SF), "test-stage")
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
        assert docs.count() == len(seen[name]) > 0
        if name != "sharding":
            assert docs.columns == C.COLUMNS
    good, single, clean, mixed, sharded = seen.values()
    labels = {r["doc_id"]: r["quality"] for r in C.table(spark, SF, "labels").collect()}
    assert sum(labels[d] == 1 for d in good if d in labels) >= 0.95 * sum(q == 1 for q in labels.values())
    rows = sorted((d, r["text"]) for d, r in good.items())
    assert set(single) == {d for (d, _), (n, c) in zip(rows, near_components(rows, C.NEAR_SIMILAR)) if not n or c == d}
    assert set(clean) == {d for d, r in single.items() if not contamination(r["text"], items)[1]}
    assert set(mixed) <= set(clean) and set(sharded) == set(mixed)
    sums = {}
    for r in sharded.values():
        sums[r["shard"]] = sums.get(r["shard"], 0) + len(r["text"].encode())
    assert all(sums[r["shard"]] == r["shard_bytes"] for r in sharded.values())


def test_stages_take_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", None, None, None), (None, "some plain words, in a row.", "en", "s", 5)]
    odd = spark.createDataFrame([(*r, 9, "x") for r in rows], "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, n INT, shard STRING")
    for docs in (odd, odd.limit(0)):
        for _, stage in C.STAGES:
            assert stage(spark, docs, SF).count() <= len(rows)
