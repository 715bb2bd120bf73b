"""Scoring with a bigram model by deleted interpolation.

A token's probability mixes three estimates: its share after its context, its
share of all tokens, and a uniform one. The weights depend on how often the context
occurs (by powers of two) and are learned by expectation maximisation on deleted
counts: each training token is judged by the counts without itself.

Counting and looking up are one exchange. Texts become chunks of local token
numbers with a dictionary of token hashes. Each chunk asks for its distinct tokens
or bigrams once, in arrays dealt out by hash range, and brings its own training counts
along; a range adds them up and answers every chunk in the order it asked. So a
frequent token is one entry per chunk, and no table of the model is ever gathered.
The weights are learned from a table of counts over rounded probabilities, whose
size does not depend on the corpus.

Hashes of 64 bits stand for tokens and hashes of 48 bits for bigrams; two that share a
hash are counted as one (with 10**11 bigrams, one in 2,800 shares its hash).

Defined cases: a null text is empty, and an empty text has the end token alone;
without training tokens all weight lies on the uniform estimate; repeated rows are
each counted and scored; an empty table gives no row; a very long text is read in
pieces and may lie in several chunks, whose sums are added; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm import text as words_of
from tarn.session import staged

#: Tokens in a chunk and entries of a range, about.
CHUNK_TOKENS, RANGE_ENTRIES = 1_000_000, 600_000
BUCKETS = 24
EM_ROUNDS = 60

_END = np.uint64(0xC2B2AE3D27D4EB4F)
_PAIR = np.uint64(0x9FB21C651E98DF25)
#: Bits of the hash of a token and of a bigram, by kind of request.
_BITS = {1: 64, 2: 48}
#: Steps of a rounded log2 probability, and how many there are; 0 stands for none.
_FINE, _STEPS = 4, 192

_CHUNK = (
    "chunk BIGINT, first BIGINT, doc_ids ARRAY<BIGINT>, held_out ARRAY<BOOLEAN>, sizes BINARY, ids BINARY, edge ARRAY<BIGINT>, "
    "entries BIGINT, tokens BIGINT, vocabulary BINARY"
)
_REQUEST = "chunk BIGINT, kind INT, part INT, keys BINARY, counts BINARY"
_ANSWER = "chunk BIGINT, kind INT, part INT, totals BINARY, all_tokens BIGINT, all_types BIGINT"
_FACTS = "first BIGINT, doc_ids ARRAY<BIGINT>, held_out ARRAY<BOOLEAN>, sizes BINARY, edge ARRAY<BIGINT>, single BINARY, pair BINARY"
_SCORES = "row BIGINT, doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE"


def pack(values: np.ndarray) -> bytes:
    """Kind, length and compressed bytes of an array, first bytes of all values first."""
    raw = np.ascontiguousarray(values)
    head = raw.dtype.str.encode().ljust(8) + len(raw).to_bytes(8, "little")
    planes = raw.view(np.uint8).reshape(len(raw), raw.dtype.itemsize).T.tobytes()
    return head + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    kind, n = np.dtype(blob[:8].decode().strip()), int.from_bytes(blob[8:16], "little")
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(blob[16:], n * kind.itemsize, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers, by their differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def _small(values: np.ndarray) -> np.ndarray:
    """In the narrowest unsigned type."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.min_scalar_type(top))


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {
        "BIGINT": pa.int64(), "INT": pa.int32(), "BINARY": pa.binary(), "DOUBLE": pa.float64(), "BOOLEAN": pa.bool_(),
        "ARRAY<BIGINT>": pa.list_(pa.int64()), "ARRAY<BOOLEAN>": pa.list_(pa.bool_()),
    }
    names, types = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], list(names))


def _rows(table) -> Iterator[dict]:
    """Rows as dicts, one at a time: each may hold megabytes."""
    for i in range(table.num_rows):
        yield table.slice(i, 1).to_pylist()[0]


def _cut(chunk_tokens: int):
    """Documents ``(doc_id, held_out, text)`` to chunks. A long text may go on in
    the next chunk; ``first`` numbers a chunk's first text and ``edge`` has the places, in
    its vocabulary, of the end and of the token before its first one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, done = TaskContext.get().partitionId(), 0, 0
        ids, held, sizes, tokens, waiting = [], [], [], [], 0
        lead = _END

        def chunk() -> pa.RecordBatch:
            nonlocal made
            vocabulary, local = np.unique(np.concatenate([[_END, lead], *tokens]), return_inverse=True)
            made += 1
            row = [
                [(part << 32) + made], [(part << 32) + done], [ids], [held], [pack(_small(np.array(sizes)))], [pack(_small(local[2:]))],
                [local[:2].tolist()], [len(vocabulary)], [len(local) - 2], [pack_sorted(vocabulary)],
            ]
            return _batch(_CHUNK, row)

        for batch in batches:
            doc_ids, folds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            going = False
            for run in words_of.word_pieces(batch.column(2), words_of.NON_SPACE, 0):
                found = run.hashes if run.goes_on else np.insert(run.hashes, run.first[1:], _END)
                if going and sizes:
                    sizes[-1] += len(found)
                else:
                    at = slice(run.lo, run.lo + len(run.first) - 1)
                    ids += doc_ids[at]
                    held += folds[at]
                    sizes += (np.diff(run.first) + (not run.goes_on)).tolist()
                tokens.append(found)
                waiting += len(found)
                going = run.goes_on
                if waiting >= chunk_tokens:
                    yield chunk()
                    done += len(ids) - going
                    lead = next(t[-1] for t in reversed(tokens) if len(t))
                    ids, held, sizes, tokens, waiting = [], [], [], [], 0
        if ids:
            yield chunk()

    return cut


class _Chunk:
    """A chunk's arrays; distinct bigrams in the order of their hashes."""

    def __init__(self, row: dict):
        self.sizes = unpack(row["sizes"]).astype(np.int64)
        self.ids = unpack(row["ids"]).astype(np.int64)
        self.edge = row["edge"]
        self.vocabulary = unpack_sorted(row["vocabulary"])
        self.train = np.repeat(~np.array(row["held_out"], bool), self.sizes)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the distinct bigrams, and each token's place there."""
        codes, place = np.unique(_before(self.ids, self.sizes, self.edge) * len(self.vocabulary) + self.ids, return_inverse=True)
        hashes = words_of.mix(
            self.vocabulary[codes // len(self.vocabulary)] * _PAIR + self.vocabulary[codes % len(self.vocabulary)]
        )
        keys, rank = np.unique(hashes >> np.uint64(64 - _BITS[2]), return_inverse=True)
        return keys, rank[place]


def _before(values: np.ndarray, sizes: np.ndarray, edge: list[int]) -> np.ndarray:
    """What each token's context has: the token before it, the end before a first
    one, and what the chunk before ended with ahead of the whole chunk."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[np.cumsum(sizes) - sizes] = edge[0]
    out[:1] = edge[1]
    return out


def _requests(kind: int, parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                chunk = _Chunk(row)
                keys, place = (chunk.vocabulary, chunk.ids) if kind == 1 else chunk.bigrams()
                counts = np.bincount(place[chunk.train], minlength=len(keys))
                edges = _edges(keys, parts, _BITS[kind])
                used = np.flatnonzero(np.diff(edges)).tolist()
                yield _batch(
                    _REQUEST,
                    [
                        [row["chunk"]] * len(used), [kind] * len(used), used,
                        [pack_sorted(keys[edges[k] : edges[k + 1]]) for k in used],
                        [pack(_small(counts[edges[k] : edges[k + 1]])) for k in used],
                    ],
                )

    return ask


def _edges(keys: np.ndarray, parts: int, bits: int) -> np.ndarray:
    """Where each of ``parts`` equal hash ranges begins among sorted keys."""
    borders = np.array([(k << bits) // parts for k in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])


def _answer(table: pa.Table) -> pa.Table:
    """Total counts of one hash range, for each chunk in the order it asked."""
    rows = table.to_pylist()
    keys, counts = [unpack_sorted(r["keys"]) for r in rows], [unpack(r["counts"]) for r in rows]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.zeros(len(distinct), np.int64)
    np.add.at(totals, place, np.concatenate([c.astype(np.int64) for c in counts]))
    ends = np.cumsum([len(k) for k in keys])
    answers = [pack(_small(totals[place[e - len(k) : e]])) for k, e in zip(keys, ends)]
    rest = [0] * (len(rows) - 1)
    return pa.Table.from_batches([
        _batch(
            _ANSWER,
            [
                [r["chunk"] for r in rows], [r["kind"] for r in rows], [r["part"] for r in rows], answers,
                [int(totals.sum()), *rest], [int((totals > 0).sum()), *rest],
            ],
        )
    ])


def _to_facts(chunks: pa.Table, answers: pa.Table) -> pa.Table:
    """Counts of each token and its bigram."""
    out = []
    for row in _rows(chunks):
        chunk = _Chunk(row)
        got = sorted(answers.to_pylist(), key=lambda r: (r["kind"], r["part"]))
        singles, pairs = (
            np.concatenate([unpack(r["totals"]).astype(np.int64) for r in got if r["kind"] == kind]) for kind in (1, 2)
        )
        _, place = chunk.bigrams()
        facts = singles[chunk.ids], pairs[place]
        edge = singles[chunk.edge].tolist()
        out.append([*(row[c] for c in ("first", "doc_ids", "held_out", "sizes")), edge, *(pack(_small(f)) for f in facts)])
    return pa.Table.from_batches([_batch(_FACTS, list(zip(*out)) if out else [[]] * 7)])


def _counts(row: dict) -> tuple[np.ndarray, ...]:
    """Of a row of facts: the texts' sizes, and counts of each token, of the token
    before it (the end before a first one), and of its bigram."""
    sizes, single, pair = (unpack(row[c]).astype(np.int64) for c in ("sizes", "single", "pair"))
    return sizes, single, _before(single, sizes, row["edge"]), pair


def _bucket(before: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(before, 0) + 1).astype(np.int64), BUCKETS - 1)


def _steps(p: np.ndarray) -> np.ndarray:
    out = np.zeros(len(p), np.int64)
    some = p > 0
    out[some] = 1 + np.clip(np.rint(-_FINE * np.log2(p[some])), 0, _STEPS - 2).astype(np.int64)
    return out


def _share(part: np.ndarray, whole) -> np.ndarray:
    return np.where(part > 0, part / np.maximum(whole, 1), 0.0)


def _deleted(n: int):
    """Counts of training tokens over bucket and rounded estimates, each token
    judged by the counts without it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                sizes, *counts = _counts(row)
                train = np.repeat(~np.array(row["held_out"], bool), sizes)
                single, before, pair = (c[train] - 1 for c in counts)
                cell = (_bucket(before) * _STEPS + _steps(_share(pair, before))) * _STEPS + _steps(_share(single, n - 1))
                cells, counts = np.unique(cell, return_counts=True)
                yield _batch("cell BIGINT, n BIGINT", [cells, counts])

    return count


def learn_weights(cells: np.ndarray, counts: np.ndarray, uniform: float) -> np.ndarray:
    """Mixture weights (bigram, token, uniform) of each bucket by expectation
    maximisation; a bucket without counts gets the weights of all buckets together."""

    def value(steps: np.ndarray) -> np.ndarray:
        return np.where(steps > 0, 2.0 ** (-(steps - 1) / _FINE), 0.0)

    def maximise(likely: np.ndarray, n: np.ndarray) -> np.ndarray:
        weights = np.full(3, 1 / 3)
        for _ in range(EM_ROUNDS):
            share = likely * weights
            share /= share.sum(axis=1, keepdims=True)
            weights = (share * n[:, None]).sum(axis=0) / n.sum()
        return weights

    if not len(cells):
        return np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    likely = np.stack(
        [value(cells // _STEPS % _STEPS), value(cells % _STEPS), np.full(len(cells), uniform)], axis=1
    )
    bucket = cells // _STEPS**2
    every = maximise(likely, counts)
    return np.stack([
        maximise(likely[bucket == b], counts[bucket == b]) if (bucket == b).any() else every for b in range(BUCKETS)
    ])


def _score(n: int, v: int, weights: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                sizes, single, before, pair = _counts(row)
                own = weights[_bucket(before)]
                mixed = own[:, 0] * _share(pair, before) + own[:, 1] * _share(single, n) + own[:, 2] / (v + 1)
                base = np.log10((single + 0.5) / (n + 0.5 * (v + 1)))
                starts = np.cumsum(sizes) - sizes
                known = np.add.reduceat((single > 0).astype(np.int64), starts)
                sums = np.add.reduceat(base, starts), np.add.reduceat(np.log10(mixed), starts)
                rows = row["first"] + np.arange(len(sizes))
                yield _batch(_SCORES, [rows, row["doc_ids"], row["held_out"], sizes, known, *sums])

    return score


def score_documents(docs: DataFrame, held_out: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``
    per document; documents that are ``held_out`` teach nothing."""
    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    chunks = staged(rows.mapInArrow(_cut(CHUNK_TOKENS), _CHUNK), "lm-chunks")
    size = chunks.agg(F.sum("entries"), F.sum("tokens")).first()
    entries, tokens = (int(x or 0) for x in size)

    def answers(kind: int, expected: int) -> DataFrame:
        parts = max(1, -(-expected // RANGE_ENTRIES))
        asked = chunks.mapInArrow(_requests(kind, parts), _REQUEST)
        return asked.groupBy("part").applyInArrow(_answer, _ANSWER)

    singles = staged(answers(1, entries), "lm-tokens")
    n, v = (int(x or 0) for x in singles.agg(F.sum("all_tokens"), F.sum("all_types")).first())
    both = singles.unionByName(answers(2, tokens)).select("chunk", "kind", "part", "totals")
    facts = chunks.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(_to_facts, _FACTS)
    facts = staged(facts, "lm-facts")
    cells = facts.mapInArrow(_deleted(n), "cell BIGINT, n BIGINT").groupBy("cell").agg(F.sum("n").alias("n"))
    table = cells.orderBy("cell").toPandas()
    weights = learn_weights(table["cell"].to_numpy(np.int64), table["n"].to_numpy(np.float64), 1 / (v + 1))
    parts = facts.mapInArrow(_score(n, v, weights), _SCORES)
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    scored = parts.groupBy("row", "doc_id", "held_out").agg(*sums).drop("row")
    return scored.withColumn("train_tokens", F.lit(n).cast("bigint"))
