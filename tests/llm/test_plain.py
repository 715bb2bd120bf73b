"""Learned operators against plain versions, one token, text or window at a time."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarn.llm import language as L
from tarn.llm import language_model as M
from tarn.llm import quality as Q
from tests.llm.brute import cut

SF = "/root/testdata/sf0.01"


def plain_scores(rows, held):
    """log10 probabilities of ``(key, text)`` rows under deleted interpolation, by definition."""
    tokens = [[*cut(t), None] for _, t in rows]
    pairs = [list(zip([None, *ts[:-1]], ts)) for ts in tokens]
    train = [i for i, (key, _) in enumerate(rows) if not held(key)]
    single = Counter(w for i in train for w in tokens[i])
    double = Counter(p for i in train for p in pairs[i])
    n, v = sum(single.values()), len(single)
    bucket = lambda count: min(int(math.log2(count + 1)), 23)
    rounded = lambda p: 2.0 ** (-min(max(round(-4 * math.log2(p)), 0), 190) / 4) if p > 0 else 0.0
    judged = {}
    for i in train:
        for before, w in pairs[i]:
            context = single[before] - 1
            after = (double[before, w] - 1) / context if double[before, w] > 1 else 0.0
            alone = (single[w] - 1) / (n - 1) if single[w] > 1 else 0.0
            judged.setdefault(bucket(context), []).append((rounded(after), rounded(alone), 1 / (v + 1)))

    def mixture(likely):
        weights = [1 / 3] * 3
        for _ in range(60):
            sums = [0.0] * 3
            for row in likely:
                parts = [w * p for w, p in zip(weights, row)]
                sums = [s + p / sum(parts) for s, p in zip(sums, parts)]
            weights = [s / len(likely) for s in sums]
        return weights

    every = mixture([row for likely in judged.values() for row in likely])
    weights = {b: mixture(likely) for b, likely in judged.items()}
    out = []
    for ps in pairs:
        total = 0.0
        for before, w in ps:
            a, b, c = weights.get(bucket(single[before]), every)
            follows = double[before, w] / single[before] if double[before, w] else 0.0
            total += math.log10(a * follows + b * single[w] / n + c / (v + 1))
        out.append(total)
    return out


def test_model_scores_equal_the_plain_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(60)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(90_001, ""), (90_002, None), (90_006, "Unheard-of words, unheard-of")]
    table = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {r["doc_id"]: r["score"] for r in M.score_documents(table, F.col("doc_id") % 5 == 1).collect()}
    expected = plain_scores(rows, lambda key: key % 5 == 1)
    assert len(got) == len(rows)
    for (key, _), score in zip(rows, expected):
        assert got[key] == pytest.approx(score, rel=1e-6)


def plain_stats(text):
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in raw))
    ends = [w[-1] for w in words]
    per = lambda count, all_: count / max(1, all_)
    number = lambda inside: per(sum(1 for b in raw if inside(b)), len(raw))
    stop = set(b".,;:?'\"-()")
    letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    return {
        "upper": number(lambda b: 65 <= b <= 90),
        "digit": number(lambda b: 48 <= b <= 57),
        "blank": number(lambda b: b == 32 or 9 <= b <= 13),
        "stop": number(lambda b: b in stop),
        "symbol": number(lambda b: b in b"#$%&*+/<=>@[\\]^_`{|}~"),
        "exclaim": number(lambda b: b == 33),
        "beyond": number(lambda b: 128 <= b < 192 or b >= 224),
        "chars": math.log1p(len(raw)),
        "words": math.log1p(len(words)),
        "lines": per(raw.count(b"\n"), len(words)),
        "word_mean": per(sum(map(len, words)), len(words)),
        "word_longest": math.log1p(max(map(len, words), default=0)),
        "repeat": per(sum(a == b for a, b in zip(words, words[1:])), len(words)),
        "distinct": per(len(set(words)), len(words)),
        "ends_odd": per(sum(not letter(b) and b not in stop and not 48 <= b <= 57 for b in ends), len(words)),
        "short": per(sum(len(w) <= 2 for w in words), len(words)),
    }


def test_compiled_rules_equal_their_plain_reading(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(-1, None), (-2, ""), (-3, " \t\n"), (-4, "A a A!! é 12 #x\nword word -- ok ok"), (-5, "x " * 50_000)]
    x = np.array([[plain_stats(t)[s] for s in Q.STATS] for _, t in rows])
    made = Q.text_stats(pa.array([t or "" for _, t in rows]))
    for k, s in enumerate(Q.STATS):
        assert made[s] == pytest.approx(x[:, k], abs=1e-12), s
    rng = np.random.default_rng(2)
    stats = np.stack([made[s] for s in Q.STATS], axis=1)
    model = Q.fit(stats, ((stats[:, 2] > np.median(stats[:, 2])) ^ (rng.random(len(rows)) < 0.1)).astype(float))
    assert len(model.rules) > 3
    table = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {r["doc_id"]: r["s"] for r in Q.with_stats(table).select("doc_id", model.score(F.col("_quality_stats")).alias("s")).collect()}
    for (key, _), values in zip(rows, stats):
        total = model.bias
        for rule in model.rules:
            if all((values[k] > at) if above else (values[k] <= at) for k, above, at in rule.tests):
                total += rule.weight
        assert got[key] == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-9)


def net(seed, languages=3):
    rng = np.random.default_rng(seed)
    n = L.FILTERS
    return L.Network(
        [f"l{i}" for i in range(languages)], rng.normal(0, 0.3, (256, L.EMBED)),
        [rng.normal(0, 0.3, (w * L.EMBED, n)) for w in L.WIDTHS], [rng.normal(0, 0.1, n) for _ in L.WIDTHS],
        rng.normal(0, 0.3, (n * len(L.WIDTHS), languages)), rng.normal(0, 0.1, languages),
    )


def plain_logits(network, window):
    """One zero-padded window: each filter at each place, its maximum, then one dense layer."""
    pooled = []
    for width, filters, bias in zip(L.WIDTHS, network.filters, network.biases):
        places = [np.concatenate([network.embed[b] for b in window[i : i + width]]) for i in range(L.WINDOW - width + 1)]
        pooled += [max(float(p @ filters[:, f] + bias[f]) for p in places) for f in range(L.FILTERS)]
    return np.maximum(pooled, 0) @ network.out + network.out_bias


def plain_loss(network, windows, labels):
    total = 0.0
    for window, label in zip(windows, labels):
        logits = plain_logits(network, window)
        total -= logits[label] - logits.max() - math.log(np.exp(logits - logits.max()).sum())
    return total / len(labels)


def test_tables_equal_a_plain_convolution():
    network, rng = net(1), np.random.default_rng(6)
    texts = ["", "a", "short text", "é" * 200, "".join(map(chr, rng.integers(32, 127, 700))), "x" * L.WINDOW]
    best, sure = L.judge(network, network.tables(), pa.array(texts))
    for text, b, s in zip(texts, best, sure):
        raw = text.encode()
        votes = np.zeros(3)
        for lo in range(0, max(1, len(raw)), L.WINDOW):
            part = raw[lo : lo + L.WINDOW]
            logits = plain_logits(network, part.ljust(L.WINDOW, b"\0"))
            logits = logits - logits.max()
            votes += (logits - math.log(np.exp(logits).sum())) * max(1, len(part))
        p = np.exp(votes / max(1, len(raw)))
        p /= p.sum()
        assert b == p.argmax() and s == pytest.approx(p.max(), abs=1e-4)


def test_gradients_equal_differences():
    network, rng = net(2), np.random.default_rng(9)
    windows, labels = rng.integers(97, 110, (3, L.WINDOW)).astype(np.uint8), np.array([0, 2, 1])
    grads = L._gradients(network, windows, labels)
    for parameter, grad in zip(network.parameters(), grads):
        # The steepest entries, where rounding hides least.
        for at in np.argsort(-np.abs(grad), axis=None)[:2]:
            place = np.unravel_index(at, grad.shape)
            kept, losses = parameter[place], []
            for step in (1e-6, -1e-6):
                parameter[place] = kept + step
                losses.append(plain_loss(network, windows, labels))
            parameter[place] = kept
            assert grad[place] == pytest.approx((losses[0] - losses[1]) / 2e-6, rel=1e-3, abs=1e-7)
