"""Importance resampling against plain counts."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tarn.llm import queries, resample, text
from tests.llm.brute import ALNUM, cut


def features(words, longest):
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def wanted(docs, target, percent=10, longest=1, buckets=10_000, min_words=20):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    cuts = [cut(t, ALNUM) for _, t in docs]
    own = Counter(bucket(f) for w in cuts for f in features(w, longest))
    aim = Counter(bucket(f) for t in target for f in features(cut(t, ALNUM), longest))
    s, t = sum(own.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets))))
    rows = []
    for (doc, _), words in zip(docs, cuts):
        found = features(words, longest)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [i for i, w in enumerate(cuts) if len(w) >= min_words]
    able.sort(key=lambda i: (-rows[i][3], rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    for rank, i in enumerate(able[: percent * len(able) // 100], 1):
        rows[i][4] = rank
    return sorted((tuple(r) for r in rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in queries.table(spark, sf, "documents").select("doc_id", "text").collect()]
    target = [r["text"] for r in queries.table(spark, sf, "benchmark").collect()]
    assert got(queries.op11_resample(spark, sf)) == wanted(docs, target)


@pytest.mark.parametrize("longest", [1, 3])
def test_odd_rows_and_long_texts(spark, monkeypatch, longest):
    rng = random.Random(longest)
    some = ["alpha", "Beta", "x" * 40, "\u00e9t\u00e9", "9", "y" * 31, "Z"]
    texts = [" ".join(rng.choice(some) for _ in range(rng.choice([0, 5, 25, 4000]))) for _ in range(60)]
    docs = [(rng.choice([None, *range(50)]), t) for t in texts] + [(1, None), (2, ""), (3, "..."), (7, texts[0]), (7, texts[0])]
    docs = [(d, t.replace(" ", rng.choice(["--", "\n", " "])) if t else t) for d, t in docs]
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    clash = ["score", "Rank", "_at", "_part", "n", "_kept_1", "bucket", "n_words", "weight"]
    frame = frame.select("*", *[F.lit("x").alias(c) for c in clash])
    target = spark.createDataFrame([(t,) for t in ["alpha Beta 9 9", None, ""]], "text STRING")
    made = resample.resample(frame, target, percent=30, longest=longest, buckets=50)
    assert made.columns == ["doc_id", "_at", "_part", "n", "_kept_1", "bucket", "n_words", "n_features", "weight", "score", "rank"]
    assert got(made) == wanted(docs, ["alpha Beta 9 9", None, ""], 30, longest, 50)
    assert got(resample.resample(frame.limit(0), target)) == []
    assert {r["rank"] for r in resample.resample(frame.limit(3), target.limit(0)).collect()} == {None}


def test_pieces_of_long_texts_hold_every_run_once(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(text, "CHUNK_BYTES", 50)
    texts = [" ".join("w" * rng.randint(1, 30) for _ in range(n)) for n in (0, 3, 200, 40, 1)] + ["z" * 500, "", None]
    column = pa.array(texts)
    for longest in (1, 2, 4):
        found = Counter()
        for run, data, starts, sizes, owner in resample._pieces(column, longest):
            for s, n, o in zip(starts, sizes, owner):
                found[run.lo + o, data[s : s + n].tobytes().decode()] += 1
        assert found == Counter((i, f) for i, t in enumerate(texts) for f in features(cut(t, ALNUM), longest))




def test_the_table_verifies_bytes(monkeypatch):
    rng = random.Random(2)
    words = ["".join(rng.choice("ab") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 31, 32, 64]))).encode() for _ in range(2000)]
    data = np.frombuffer(b" ".join(words) + b"\0" * 32, np.uint8)
    sizes = np.array([len(w) for w in words])
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    assert [int(h) for h in resample.xxhash64(data, starts, sizes)] == [xxhash.xxh64_intdigest(w) for w in words]
    # With one key for all, only the bytes tell features apart.
    for same in (False, True):
        if same:
            monkeypatch.setattr(resample, "xxhash64", lambda data, starts, sizes: np.zeros(len(starts), np.uint64))
        table, counts = resample.Features(data, starts, sizes, 97), Counter(words)
        assert [table.count[s] for s in table.slots] == [counts[w] for w in words]
        assert [table.bucket[s] for s in table.slots] == [zlib.crc32(w) % 97 for w in words]
