"""Operators that cut, compare, mix and shard."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.llm import decontaminate as D
from tarn.llm import line_dedup as LD
from tarn.llm import mixing as X
from tarn.llm import near_dup as N
from tarn.llm import nearest as V
from tarn.llm import sharding as S
from tests.llm.brute import contamination, line_dedup, near_components

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING"


def split_by_hand(rows, limit):
    """Extendible hashing, one bucket at a time."""
    hashed = [(int(hashlib.md5(("" if k is None else str(k)).encode()).hexdigest()[:15], 16), len((t or "").encode())) for k, t in rows]
    out, todo = {}, [("", hashed)]
    while todo:
        bits, own = todo.pop()
        if sum(b for _, b in own) <= limit or len(own) == 1:
            out |= {h: bits for h, _ in own}
            continue
        for bit in "01":
            part = [(h, b) for h, b in own if f"{h:060b}"[len(bits)] == bit]
            if part:
                todo.append((bits + bit, part))
    return [out[h] for h, _ in hashed]


@pytest.mark.parametrize("limit", [50, 700, 10**9])
def test_only_large_buckets_split(spark, limit):
    rng = random.Random(limit)
    rows = [(i, "x" * rng.randint(0, 90)) for i in range(300)] + [(1000, None), (None, "null key"), (1001, "y" * 5000)]
    table = spark.createDataFrame([(*r, "clash", "kept") for r in rows], "doc_id BIGINT, text STRING, depth STRING, more STRING")
    got = S.shard(table, limit).collect()
    expected = Counter(zip([r[0] for r in rows], split_by_hand(rows, limit)))
    assert Counter((r["doc_id"], r["shard"]) for r in got) == expected
    sums = Counter()
    for r in got:
        sums[r["shard"]] += len((r["text"] or "").encode())
    assert all(sums[r["shard"]] == r["shard_bytes"] and r["depth"] == len(r["shard"]) for r in got)
    assert S.shard(table.limit(0), limit).count() == 0


def test_one_key_over_the_limit_is_paged(spark):
    rows = [(7, "z" * 30)] * 200 + [(7, "big" * 100), (8, "other")]
    got = S.shard(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5), 1000).collect()
    assert len(got) == 202
    sums, sizes = Counter(), Counter()
    for r in got:
        sums[r["shard"]] += len(r["text"])
        sizes[r["shard"]] += 1
    assert all(sums[r["shard"]] == r["shard_bytes"] <= 1000 for r in got)
    assert len(sums) < 30


BENCH = [
    (1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short, item!"), (3, ""), (4, None),
    (None, "no id at all"), (5, "one two three four five six seven eight nine ten x"), (10, "short item"),
]
TEXTS = [
    "prefix One two-three four five six seven eight nine ten eleven, twelve suffix", "a short item", "short", None, "", "!!! ???",
    "two three four five six seven eight nine ten", "one two three four five six seven eight nine ten x", "no id at all",
    "w " * 100_000 + "short item" + " w" * 1000, "Élan short\x00item",
]


@pytest.mark.parametrize("block", [200_000, 2])
def test_contamination_equals_comparison(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_WINDOWS", block)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id BIGINT, text STRING, n_words INT")
    items = spark.createDataFrame([(*r, "x") for r in BENCH], "item_id BIGINT, text STRING, window STRING")
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in D.scan(docs, items).collect())
    expected = Counter()
    for d, t in rows:
        n, hit, found = contamination(t, BENCH)
        expected[(d, n, hit, tuple(found))] += 1
    assert got == expected
    clean = D.clean(docs, items)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(d for d, t in rows if not contamination(t, BENCH)[1])
    if block > 2:
        cut = {r["doc_id"]: r["text"] for r in D.clean(docs, items, spans=True).collect()}
        assert cut[0] == "prefix  suffix" and cut[1] == "a " and cut[3] is None and cut[5] == "!!! ???" and cut[10] == "Élan "
        assert D.scan(docs, items.limit(0)).where("n_hit > 0").count() == 0
        assert D.scan(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("min_words", [1, 4])
def test_line_runs_equal_comparison(spark, min_words):
    rng = random.Random(min_words)
    lines = ["a b", "c", "d e f", "", "g h i j k", " "]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9)))) for i in range(60)]
    rows += [(60, None), (61, ""), (3, rows[3][1]), (None, rows[5][1]), (62, "m n o p q"), (2, "m n o p q"), (2, "u v w x")]
    table = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id BIGINT, text STRING, n_runs INT, more STRING")
    expected = line_dedup(rows, min_words)
    got = LD.dedup_lines(table, min_words).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[1] is None)
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=key) == sorted(((d, expected[(d, t)]) for d, t in rows), key=key)
    assert LD.dedup_lines(table.limit(0), min_words).count() == 0


def test_margins_of_the_mixture(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(1, 40), rng.choice(["en", "en", "de", None]), rng.choice(["s0", "s0", "s0", "s1", "s2"])) for i in range(3000)]
    rows += [(5000, None, "en", "s9"), (5001, "", "zz", None), (5002, "a b", "de", None), (5002, "a b", "de", None)]
    docs = spark.createDataFrame([(*r, "old") for r in rows], DOCS + ", p STRING")
    targets = {"source": 0.5, "lang": {"en": 0.7, "de": 0.2}}
    got = X.mix(docs, targets, rounds=20).collect()
    assert len(got) == len(rows) and "topic" not in got[0].asDict()
    mass = Counter()
    for r in got:
        mass[r["lang"] or ""] += r["p"] * r["n_tokens"]
    total = sum(mass.values())
    own = sum(r["n_tokens"] for r in got if r["lang"] is None) / sum(r["n_tokens"] for r in got)
    assert mass[""] / total == pytest.approx(own, abs=1e-4)
    assert mass["en"] / mass["de"] == pytest.approx(3.5, rel=1e-3)
    assert max(r["p"] for r in got) == 1.0 and all(r["kept"] for r in got if not r["n_tokens"])
    assert len({r["kept"] for r in got if r["doc_id"] == 5002}) == 1
    share = sum(r["kept"] for r in got) / len(got)
    assert abs(share - sum(r["p"] for r in got) / len(got)) < 0.05
    assert X.mix(docs.limit(0), targets).count() == 0


def near_rows(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 5000)}"
    rows = []
    for g in range(6):
        base = [word() for _ in range(rng.choice([4, 12, 60, 200]))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((rng.randint(0, 10**6), " ".join(copy)))
    base = [word() for _ in range(150)]
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.randint(1, 4)):
            copy[rng.randrange(150)] = word()
        rows.append((rng.randint(0, 10**6), " ".join(copy)))
    rows += [(5, None), (6, ""), (7, " \t"), (8, "One two"), (9, "one  TWO"), (9, "one  TWO"), (None, "one two"), (None, "alone here"), (10, "é " * 40_000)]
    return rows


@pytest.mark.parametrize("seed,tile", [(1, 1024), (2, 8)])
def test_components_equal_comparison(spark, monkeypatch, seed, tile):
    monkeypatch.setattr(N, "TILE", tile)
    rows = near_rows(seed)
    docs = spark.createDataFrame([(*r, "en", "s", 3) for r in rows], DOCS + ", n INT")
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in N.link(docs).collect())
    expected = Counter((d, n, c if n else d) for (d, _), (n, c) in zip(rows, near_components(rows)))
    assert got == expected
    if tile == 8:
        kept = N.keep_one(docs)
        assert kept.columns == docs.columns
        groups = {}
        for (d, t), (n, c) in zip(rows, near_components(rows)):
            groups.setdefault((c if n else ("empty", d)), d)
        assert kept.count() == len(groups)
        assert N.link(docs.limit(0)).count() == 0


def test_links_that_no_pivot_sees(spark):
    """Two chains side by side: the exact round finds what pivots cannot."""
    from tarn.llm.components import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a BIGINT, b BIGINT")
    got = {r["node"]: r["comp"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_nearest_equals_comparison_on_few_vectors(spark):
    rng = np.random.default_rng(6)
    good = [(i, rng.normal(size=8).round(2).tolist(), "x") for i in range(120)]
    good += [(200 + i, good[0][1], "copy") for i in range(40)] + [(300, good[7][1], "again"), (7, good[7][1], "repeated")]
    bad = [(400, None, ""), (420, [0.0] * 8, ""), (440, [1.0, None] * 4, ""), (460, [float("nan")] * 8, ""), (480, [1.0], ""), (None, [1.0] * 8, "")]
    table = spark.createDataFrame(good + bad, "vec_id BIGINT, embedding ARRAY<FLOAT>, score STRING")
    got = V.nearest(table, F.col("id") % 20 == 0, k=20).collect()
    x = {i: np.array(v, np.float32).astype(float) for i, v, _ in good}
    ids = np.array(sorted(x))
    full = np.stack([x[i] for i in ids])
    hit = total = 0
    for q in [i for i in ids if i % 20 == 0]:
        rows = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        score = V.exact(x[q], full)
        best = [i for _, i in sorted((-s, i) for s, i in zip(score.tolist(), ids.tolist()) if i != q)][:20]
        hit += len(set(best) & {r["vec_id"] for r in rows})
        total += 20
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert all(r["score"] == score[np.searchsorted(ids, r["vec_id"])] for r in rows)
        assert [(-r["score"], r["vec_id"]) for r in rows] == sorted((-r["score"], r["vec_id"]) for r in rows)
    assert hit / total >= 0.9
    copies = [r["vec_id"] for r in got if r["query_id"] == 220]
    assert copies == sorted(copies) and 0 in copies and 220 not in copies
    assert V.nearest(table.limit(0), F.lit(True)).count() == 0
    assert V.nearest(table.where("vec_id IN (0, 1)"), F.lit(True)).count() == 2


def test_visits_come_in_order_and_cross_no_cell_twice():
    made = V.visits(4, 80)
    assert made[0].sum() == 0 and len(made) == len({tuple(r) for r in made})
    assert not (made & made[:, ::-1]).any()


def test_items_without_id_hit_and_are_not_listed(spark):
    items = spark.createDataFrame([(None, "one two three"), (7, "four five"), (None, "four five")], "item_id BIGINT, text STRING")
    docs = spark.createDataFrame([(1, "a One, two three b"), (2, "four five"), (3, "one two")], "doc_id BIGINT, text STRING")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["items"]) for r in D.scan(docs, items).collect()}
    assert got == {1: (3, 0, []), 2: (2, 1, ["7"]), 3: (0, 0, [])}
    assert [r["doc_id"] for r in D.clean(docs, items).collect()] == [3]


def test_windows_across_the_pieces_of_a_long_text(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    texts = ["x " * (1_000_000 - pad) + item + " y" * 1_200_000 + " " + item + " z" * 900 for pad in (0, 10, 20, 30, 40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(5)
    items = spark.createDataFrame([(1, item), (2, "z z")], "item_id BIGINT, text STRING")
    got = D.scan(docs, items).select("doc_id", "n_words", "n_hit", "items").collect()
    wanted = {i: (1_000_000 - pad + 1_200_000 + 900 + 22, 22 + 900, ["1", "2"]) for i, pad in enumerate((0, 10, 20, 30, 40))}
    assert {r["doc_id"]: tuple(r[1:]) for r in got} == wanted
