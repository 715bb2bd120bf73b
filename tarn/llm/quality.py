"""Quality by a sparse rule ensemble.

Statistics of the whole text come first, in numpy over Arrow batches. Small
trees are boosted on a bounded sample of labelled rows; each path from a root to
a node is a rule, a conjunction of thresholds on statistics. A logistic model
with an L1 penalty keeps few of the rules, and those are compiled into Spark
column expressions, which score all documents.

The sample is the ``SAMPLE_ROWS`` labelled rows of the smallest hash. Labels,
language, source and id are never inputs of a score.

Defined cases: a null text counts as empty, and all its statistics are 0; without
labels every score is 0.5; with one class alone it is that class's smoothed share;
a document with several labels counts with each; repeated rows are each scored;
an empty table gives no row; a very long text is read in pieces, of which totals and distinct
words are kept; further columns are kept, but columns named ``score`` or
``predicted``, in any case of letters, are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.llm import text as words_of
from tarn.llm.columns import place, restored, sheltered
from tarn.session import staged

SAMPLE_ROWS = 20_000
TREES, DEPTH, SHRINK, BINS = 24, 3, 0.3, 32
PENALTY = 1e-3

STATS = (
    "chars words lines upper digit blank stop symbol exclaim beyond word_mean word_longest repeat distinct ends_odd short"
).split()

_STRUCT = T.StructType([T.StructField(s, T.DoubleType()) for s in STATS])


def _table(inside) -> np.ndarray:
    return np.array([inside(b) for b in range(256)], np.uint8)


_LETTER = _table(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_CLASSES = {
    "upper": _table(lambda b: 65 <= b <= 90),
    "digit": _table(lambda b: 48 <= b <= 57),
    "blank": _table(lambda b: b == 32 or 9 <= b <= 13),
    "stop": _table(lambda b: chr(b) in ".,;:?'\"-()"),
    "symbol": _table(lambda b: chr(b) in "#$%&*+/<=>@[\\]^_`{|}~"),
    "exclaim": _table(lambda b: b == 33),
    "beyond": _table(lambda b: 128 <= b < 192 or b >= 224),
}
_NEWLINE = _table(lambda b: b == 10)
_COUNTS = "size count lines length longest repeat distinct ends_odd short".split()

def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    if len(bounds) == 2:
        return np.array([values.sum(dtype=np.int64)])
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def text_stats(column: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of each text, by name. Totals are added up over the pieces of a long text."""
    n = len(column)
    sums = {k: np.zeros(n, np.int64) for k in (*_CLASSES, *_COUNTS)}
    last_word, kinds = np.zeros(0, np.uint64), []
    for run in words_of.word_pieces(column, words_of.NON_SPACE, 0):
        texts = len(run.bounds) - 1
        at = slice(run.lo, run.lo + texts)
        count = np.diff(run.first)
        length = run.ends - run.starts
        owner = np.repeat(np.arange(texts), count)
        sums["size"][at] += np.diff(run.bounds)
        sums["count"][at] += count
        for name, table in (*_CLASSES.items(), ("lines", _NEWLINE)):
            sums[name][at] += _sums(table[run.raw], run.bounds)
        sums["length"][at] += _sums(length, run.first)
        np.maximum.at(sums["longest"][at], owner, length)
        same = np.zeros(len(length), np.int64)
        same[1:] = (run.hashes[1:] == run.hashes[:-1]) & (owner[1:] == owner[:-1])
        if len(same) and len(last_word):
            same[0] = run.hashes[0] == last_word[0]
        sums["repeat"][at] += _sums(same, run.first)
        last = run.data[run.ends - 1] if len(length) else run.data[:0]
        odd = (_LETTER[last] == 0) & (_CLASSES["stop"][last] == 0) & (_CLASSES["digit"][last] == 0)
        sums["ends_odd"][at] += _sums(odd, run.first)
        sums["short"][at] += _sums(length <= 2, run.first)
        if run.goes_on or kinds:
            kinds.append(np.unique(run.hashes))
            last_word = run.hashes[-1:] if len(length) else last_word
            if not run.goes_on:
                sums["distinct"][run.lo] = len(np.unique(np.concatenate(kinds)))
                last_word, kinds = last_word[:0], []
            continue
        order = np.lexsort((run.hashes, owner))
        fresh = np.ones(len(length), np.int64)
        fresh[1:] = (run.hashes[order][1:] != run.hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        sums["distinct"][at] = _sums(fresh, run.first)
    per_byte, per_word = 1 / np.maximum(sums["size"], 1), 1 / np.maximum(sums["count"], 1)
    out = {"chars": np.log1p(sums["size"]), "words": np.log1p(sums["count"]), "word_longest": np.log1p(sums["longest"])}
    out |= {k: sums[k] * per_byte for k in _CLASSES} | {"word_mean": sums["length"] * per_word}
    return out | {k: sums[k] * per_word for k in ("lines", "repeat", "distinct", "ends_odd", "short")}


@F.arrow_udf(_STRUCT)
def _stats(column: pa.Array) -> pa.Array:
    made = text_stats(column)
    return pa.StructArray.from_arrays([pa.array(made[s]) for s in STATS], names=STATS)


def with_stats(docs: DataFrame, text: str = "text", name: str = "_quality_stats") -> DataFrame:
    return docs.withColumn(name, _stats(F.coalesce(F.col(text), F.lit(""))))


@dataclass(frozen=True)
class Rule:
    """``sum of weights`` is added where all (statistic, is_above, threshold) hold."""

    tests: tuple[tuple[int, bool, float], ...]
    weight: float


@dataclass(frozen=True)
class Model:
    bias: float
    rules: tuple[Rule, ...]

    def score(self, stats: Column) -> Column:
        total = F.lit(self.bias)
        for rule in self.rules:
            holds = F.lit(True)
            for k, above, threshold in rule.tests:
                value = stats.getField(STATS[k])
                holds = holds & ((value > threshold) if above else (value <= threshold))
            total = total + F.when(holds, F.lit(rule.weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _grow(binned, gradient, hessian, rows, depth, path, edges, leaves, rules) -> None:
    """Split ``rows`` where the gain is largest. Paths to nodes are rules; a path
    to a leaf comes with the leaf's Newton step."""
    if path:
        rules.add(path)
    best = (1e-6, None)
    g, h = gradient[rows], hessian[rows]
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    if depth and len(rows) >= 20:
        for k in range(binned.shape[1]):
            gs = np.cumsum(np.bincount(binned[rows, k], g, BINS))
            hs = np.cumsum(np.bincount(binned[rows, k], h, BINS))
            gain = gs**2 / (hs + 1.0) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1.0) - whole
            b = int(gain[:-1].argmax())
            if b < len(edges[k]) and gain[b] > best[0]:
                best = (gain[b], (k, b))
    if best[1] is None:
        leaves.append((path, g.sum() / (h.sum() + 1.0)))
        return
    k, b = best[1]
    below = binned[rows, k] <= b
    threshold = float(edges[k][b])
    for side, above in ((below, False), (~below, True)):
        own = tuple(sorted({*path, (k, above, threshold)}))
        _grow(binned, gradient, hessian, rows[side], depth - 1, own, edges, leaves, rules)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost small trees, take all their paths as rules, and weigh them by
    logistic regression with an L1 penalty (accelerated proximal gradient)."""
    n = len(y)
    share = (y.sum() + 1) / (n + 2)
    prior = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return Model(0.0 if n == 0 else prior, ())
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    rng = np.random.default_rng(7)
    margin, rules = np.full(n, prior), set()
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        leaves: list = []
        rows = np.flatnonzero(rng.random(n) < 0.7)
        _grow(binned, y - p, p * (1 - p), rows, DEPTH, (), edges, leaves, rules)
        for path, step in leaves:
            margin[_holds(x, path)] += SHRINK * step
    tests = sorted(rules)
    if not tests:
        return Model(prior, ())
    cover = np.stack([_holds(x, t) for t in tests], axis=1)
    _, distinct = np.unique(cover, axis=1, return_index=True)
    tests = [tests[i] for i in sorted(distinct)]
    cover = np.stack([_holds(x, t) for t in tests], axis=1).astype(np.float64)
    weights, bias = _lasso(cover, y, prior)
    return Model(bias, tuple(Rule(t, float(w)) for t, w in zip(tests, weights) if w))


def _holds(x: np.ndarray, tests) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, above, threshold in tests:
        out &= (x[:, k] > threshold) if above else (x[:, k] <= threshold)
    return out


def _lasso(cover: np.ndarray, y: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    n, m = cover.shape
    w, b = np.zeros(m), bias
    rate = 4.0 / max(np.linalg.norm(cover, 2) ** 2 / n + 1.0, 1e-9)
    v, vb, momentum = w.copy(), b, 1.0
    for _ in range(400):
        p = 1 / (1 + np.exp(-(cover @ v + vb)))
        new = v - rate * (cover.T @ (p - y)) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * PENALTY, 0)
        new_b = vb - rate * float((p - y).mean())
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v = new + (momentum - 1) / following * (new - w)
        vb = new_b + (momentum - 1) / following * (new_b - b)
        w, b, momentum = new, new_b, following
    return w, float(b)


def train(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, name: str = "_quality_stats") -> Model:
    """Fit on the labelled rows of ``stats (doc_id, _quality_stats)``: those
    ``sample_rows`` at most that have the smallest hash."""
    known = labels.where("quality IS NOT NULL").select("doc_id", F.col("quality").cast("double").alias("_y"))
    rows = stats.select("doc_id", name).join(known, "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "_y", f"{name}.chars").limit(sample_rows)
    taken = rows.select("_y", *[F.col(f"{name}.{s}").alias(f"_{k}") for k, s in enumerate(STATS)]).toPandas()
    table = taken.to_numpy(np.float64)
    return fit(table[:, 1:], table[:, 0])


def score_documents(docs: DataFrame, labels: DataFrame, learn_from: Column, text: str = "text") -> DataFrame:
    """``docs`` without their text, with ``score`` and ``predicted``. Statistics
    are taken once and written; learning and scoring read them."""
    docs = docs.drop("score", "predicted")
    rows = docs.select("*", learn_from).toDF(*sheltered(docs).columns, "_learn")
    stats = staged(with_stats(rows, place(docs, text)).drop(place(docs, text)), "quality-stats")
    known = stats.where("_learn").select(F.col(place(docs, "doc_id")).alias("doc_id"), "_quality_stats")
    score = train(known, labels).score(F.col("_quality_stats"))
    scored = stats.withColumn("score", score).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    own = [F.col(place(docs, c)).alias(c) for c in docs.columns if c != text]
    return scored.select(*own, "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, learn_from: Column, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more, unchanged. Which rows are
    learned from follows from ids and labels alone, so statistics are taken of those at most
    ``SAMPLE_ROWS`` ids for the fit, and of each row once for its score."""
    known = labels.where("quality IS NOT NULL").select("doc_id", F.col("quality").cast("double").alias("_y"))
    ids = docs.select("doc_id").where(learn_from).join(known, "doc_id")
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id", "_y").limit(SAMPLE_ROWS).select("doc_id").distinct()
    sample = docs.select("doc_id", text).where(learn_from).join(F.broadcast(ids), "doc_id", "left_semi")
    model = train(with_stats(sample, text), labels)
    scored = with_stats(sheltered(docs), place(docs, text))
    return restored(scored.where(model.score(F.col("_quality_stats")) >= 0.5), docs)
