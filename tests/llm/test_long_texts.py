"""Texts that are read in pieces give what they give whole, in bounded memory."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarn.llm import language_model as M
from tarn.llm import near_dup as N
from tarn.llm import quality as Q
from tarn.llm import text
from tests.llm.brute import cut

DOCS = "doc_id BIGINT, text STRING"


def some_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abAB!é7") for _ in range(rng.choice([1, 2, 3, 9])))
    texts = [" ".join(word() for _ in range(rng.choice([0, 1, 3, 4, 5, 40, 200]))) for _ in range(12)]
    texts += ["one two three four", "one" + " \n" * 90 + "two three four" + " " * 200, "w" * 300, " " * 300, "a a " * 80, "", "end. " * 30]
    rng.shuffle(texts)
    return pa.array([*texts, None])


def sets(column):
    return {i: s.tolist() for i, s in N.shingle_sets(column)}


@pytest.mark.parametrize("seed", range(6))
def test_pieces_give_the_same_sets_and_statistics(monkeypatch, seed):
    column = some_texts(seed)
    whole, stats = sets(column), Q.text_stats(column)
    assert {i: len(s) for i, s in whole.items()} == {
        i: len({tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))}) for i, t in enumerate(column.to_pylist()) if (ws := cut(t))
    }
    for size in (1, 7, 50, 130):
        monkeypatch.setattr(text, "CHUNK_BYTES", size)
        assert sets(column) == whole
        made = Q.text_stats(column)
        assert all(np.array_equal(made[s], stats[s]) for s in Q.STATS)


@pytest.mark.parametrize("long_text", ["words", "one word", "blanks"])
def test_memory_follows_the_distinct_words(long_text):
    size = 16_000_000
    rng = np.random.default_rng(1)
    made = {"words": lambda: " ".join(map(str, rng.integers(0, 30_000, size // 6))), "one word": lambda: "x" * size, "blanks": lambda: " " * size}
    column = pa.array([made[long_text]()])
    text._power_tables(text.CHUNK_BYTES)
    tracemalloc.start()
    Q.text_stats(column)
    sets_of = list(N.shingle_sets(column))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    held = sum(s.nbytes for _, s in sets_of)
    assert peak < 130_000_000 + 4 * held + 3 * size


def test_a_text_over_several_chunks_has_one_score(spark, monkeypatch):
    rng = random.Random(3)
    words = ["the", "cat", "sat", "on", "a", "mat", "and", "ran"]
    long_text = " ".join(rng.choice(words) for _ in range(1_300_000))
    rows = [(1, "the cat sat"), (2, long_text), (2, "a mat"), (None, long_text[:2_500_000] + " " * 4_100_000), (6, long_text[:-9]), (7, None), (9, "cat")]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)

    def read():
        got = M.score_documents(docs, F.col("doc_id") == 6).collect()
        return sorted(got, key=lambda r: (r["doc_id"] or 0, r["n_tokens"]))

    whole = read()
    assert [(r["doc_id"], r["n_tokens"]) for r in whole] == sorted(((d, len(cut(t)) + 1) for d, t in rows), key=lambda x: (x[0] or 0, x[1]))
    for tokens in (1, 10**9):
        monkeypatch.setattr(M, "CHUNK_TOKENS", tokens)
        for a, b in zip(whole, read()):
            assert (a["doc_id"], a["n_tokens"], a["n_known"], a["train_tokens"]) == (b["doc_id"], b["n_tokens"], b["n_known"], b["train_tokens"])
            assert a["base_score"] == pytest.approx(b["base_score"]) and a["score"] == pytest.approx(b["score"])
