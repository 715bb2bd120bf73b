"""Language identification by a byte convolutional network.

Bytes are embedded; filters of several widths run over fixed windows, each
filter's largest value over a window goes to a softmax. The network is trained
in numpy, by backpropagation with Adam, on one window of each sampled document.
For use, embedding and filters fold into one lookup table per filter offset, or
per pair of bytes, and all windows of a text vote with their log probabilities.

The sample is the ``SAMPLE_PER_LANGUAGE`` documents of each language with the
smallest hash, one window of each at a hashed place.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
with nothing to learn from, every text is; a single language scores 1;
repeated rows are each judged; an empty table gives no row; all windows of a very long
text vote, some hundreds at a time; further columns are kept, but columns named
``lang_pred`` or ``score``, in any case of letters, are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarn.llm import text as words_of
from tarn.llm.columns import place, restored, sheltered

SAMPLE_PER_LANGUAGE = 600
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS, EMBED, EPOCHS, BATCH = 16, 8, 8, 64
#: Windows judged at once.
_AT_ONCE = 512


def to_windows(texts: list[bytes]) -> np.ndarray:
    """One zero-padded window per text."""
    out = np.zeros((len(texts), WINDOW), np.uint8)
    for i, t in enumerate(texts):
        out[i, : min(len(t), WINDOW)] = np.frombuffer(t[:WINDOW], np.uint8)
    return out


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.biases, self.out, self.out_bias]

    def tables(self) -> list[list[np.ndarray]]:
        """Per width, filter outputs of a byte pair (and of a last single byte)
        by offset."""
        made = []
        for width, f, bias in zip(WIDTHS, self.filters, self.biases):
            single = [(self.embed @ f[j * EMBED : (j + 1) * EMBED]).astype(np.float32) for j in range(width)]
            single[0] = single[0] + bias.astype(np.float32)
            pairs = [
                (single[j][:, None, :] + single[j + 1][None, :, :]).reshape(65536, FILTERS)
                for j in range(0, width - 1, 2)
            ]
            made.append(pairs + ([single[-1]] if width % 2 else []))
        return made


def _columns(x: np.ndarray, width: int) -> np.ndarray:
    n, length, d = x.shape
    step = x.strides
    return np.lib.stride_tricks.as_strided(
        x, (n, length - width + 1, width * d), (step[0], step[1], step[2])
    )


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 3) -> Network:
    rng = np.random.default_rng(seed)
    net = Network(
        languages,
        rng.normal(0, 0.3, (256, EMBED)),
        [rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS)) for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))),
        np.zeros(len(languages)),
    )
    params = net.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // BATCH)):
            x, y = windows[at].copy(), labels[at]
            # Short texts exist: half of the windows are cut at a random length.
            for row in np.flatnonzero(rng.random(len(at)) < 0.5):
                x[row, rng.integers(12, WINDOW) :] = 0
            grads = _gradients(net, x, y)
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    n = len(y)
    embedded = net.embed[x]
    pooled, picks = [], []
    for width, f, bias in zip(WIDTHS, net.filters, net.biases):
        made = _columns(embedded, width) @ f + bias
        best = made.argmax(axis=1)
        picks.append(best)
        pooled.append(np.take_along_axis(made, best[:, None, :], 1)[:, 0, :])
    raw = np.concatenate(pooled, axis=1)
    hidden = np.maximum(raw, 0)
    logits = hidden @ net.out + net.out_bias
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(n), y] -= 1
    p /= n
    back = (p @ net.out.T) * (raw > 0)
    d_embed, d_filters, d_biases = np.zeros_like(net.embed), [], []
    rows = np.arange(n)[:, None]
    for k, (width, f) in enumerate(zip(WIDTHS, net.filters)):
        d = back[:, k * FILTERS : (k + 1) * FILTERS]
        taken = _columns(embedded, width)[rows, picks[k]]
        d_filters.append(np.einsum("nfi,nf->if", taken, d))
        d_biases.append(d.sum(axis=0))
        d_taken = (d[:, :, None] * f.T[None]).reshape(n, FILTERS, width, EMBED)
        for j in range(width):
            np.add.at(d_embed, x[rows, picks[k] + j], d_taken[:, :, j])
    return [d_embed, *d_filters, *d_biases, hidden.T @ p, p.sum(axis=0)]


def judge(net: Network, tables: list[list[np.ndarray]], column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Best language and its probability for each text; texts without a byte
    get the network's answer to an empty window."""
    best = np.zeros(len(column), np.int64)
    sure = np.zeros(len(column))
    for lo, data, bounds in words_of.chunks(column):
        size = np.diff(bounds)
        n = len(size)
        count = np.maximum(1, -(-size // WINDOW))
        owner = np.repeat(np.arange(n), count)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        starts = bounds[owner] + place * WINDOW
        length = np.minimum(bounds[owner + 1] - starts, WINDOW)
        padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
        votes = np.zeros((n, len(net.languages)))
        for a in range(0, len(owner), _AT_ONCE):
            s, m = starts[a : a + _AT_ONCE], length[a : a + _AT_ONCE]
            x = padded[s[:, None] + np.arange(WINDOW)]
            x[np.arange(WINDOW)[None, :] >= m[:, None]] = 0
            logp = _log_probabilities(net, tables, x)
            np.add.at(votes, owner[a : a + _AT_ONCE], logp * np.maximum(m, 1)[:, None])
        votes /= np.maximum(size, 1)[:, None]
        p = np.exp(votes - votes.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best[lo : lo + n] = p.argmax(axis=1)
        sure[lo : lo + n] = p.max(axis=1)
    return best, sure


def _log_probabilities(net: Network, tables: list[list[np.ndarray]], x: np.ndarray) -> np.ndarray:
    pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
    pooled = []
    for width, parts in zip(WIDTHS, tables):
        places = WINDOW - width + 1
        made = np.take(parts[0], pair[:, :places], axis=0)
        for j, part in enumerate(parts[1:], 1):
            at = pair[:, 2 * j : 2 * j + places] if len(part) == 65536 else x[:, width - 1 : width - 1 + places]
            made += np.take(part, at, axis=0)
        pooled.append(made.max(axis=1))
    logits = np.maximum(np.concatenate(pooled, axis=1), 0) @ net.out + net.out_bias
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def learn(docs: DataFrame, learn_from: Column, text: str = "text", lang: str = "lang") -> Network | None:
    """Train on the sample of ``docs`` that ``learn_from`` allows."""
    spread = F.xxhash64("doc_id", text)
    rows = docs.where(learn_from).where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    start = F.pmod(spread, F.greatest(F.length(text) - WINDOW, F.lit(1))).cast("int") + 1
    rows = rows.select(F.col(lang).alias("lang"), F.substring(F.col(text), start, F.lit(WINDOW)).alias("part"), spread.alias("spread"))
    order = Window.partitionBy("lang").orderBy("spread", "part")
    rows = rows.withColumn("k", F.row_number().over(order)).where(F.col("k") <= SAMPLE_PER_LANGUAGE)
    taken = sorted((r["lang"], r["k"], r["part"]) for r in rows.select("lang", "k", "part").collect())
    if not taken:
        return None
    languages = sorted({t[0] for t in taken})
    labels = np.array([languages.index(t[0]) for t in taken])
    return train(to_windows([t[2].encode() for t in taken]), labels, languages)


def identify(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    und = F.lit("und").alias("lang"), F.lit(0.0).alias("score")
    if net is None:
        return docs.withColumn("lang_pred", und[0]).withColumn("score", und[1])
    shared = docs.sparkSession.sparkContext.broadcast(net)
    made: list = []

    @F.arrow_udf("struct<lang: string, score: double>")
    def guess(column: pa.Array) -> pa.Array:
        network = shared.value
        if not made:
            made.append(network.tables())
        best, sure = judge(network, made[0], column)
        names = pa.array(network.languages).take(pa.array(best))
        return pa.StructArray.from_arrays([names, pa.array(sure)], names=["lang", "score"])

    docs = docs.drop("lang_pred", "score")
    text = place(docs, text)
    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    found = F.when(has_letter, guess(F.coalesce(F.col(text), F.lit("")))).otherwise(F.struct(*und))
    made = sheltered(docs).withColumn("_guess", found)
    made = made.withColumn("lang_pred", F.col("_guess.lang")).withColumn("score", F.col("_guess.score"))
    return restored(made, docs, "lang_pred", "score")
