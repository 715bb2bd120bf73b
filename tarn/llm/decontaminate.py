"""Benchmark decontamination by a broadcast set of n-grams.

Every run of ``n`` consecutive words of a benchmark item is a window; an item of
fewer words is one window. Documents are scanned once: window hashes of a batch
come from numpy, a bitmap and a sorted table find those in the set, and each
find is verified on its bytes. All words under a verified window are hit.

The set is broadcast only in blocks of about ``BLOCK_WINDOWS`` pairs of window and
item, so that a window of very many items is spread as well. One block is one
narrow pass; a benchmark of more blocks is scanned block after block, with the
hits written in between, so that no task holds more than one.

Defined cases: a null text has no words; an item without words has no window; the windows of items with a null
``item_id`` hit as all others do, but such an item is in no list and no count of items; repeated rows are each judged; an empty
table gives no row, an empty benchmark no hit; further columns of either table are
ignored by ``scan`` and kept by ``clean``. A very long text is scanned in pieces of bounded size, which share the words that
a window across their border needs; taking spans out of one (``clean`` with ``spans``) works on it whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.llm import text as words_of
from tarn.session import staged

WINDOW = 10
BLOCK_WINDOWS = 200_000
_BITS = 22

_FOUND = ("_hit_from", "_hit_to", "_hit_items")


def benchmark_windows(items: DataFrame, n: int = WINDOW) -> DataFrame:
    """``(size, window, item)``: each distinct window of an item, its words joined
    by spaces, with the item's id as a string, null where it has none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column("item_id"), []
            for run in words_of.words(batch.column("text"), words_of.ALNUM):
                for i in range(len(run.first) - 1):
                    lo, hi = run.first[i], run.first[i + 1]
                    found = [run.word(k) for k in range(lo, hi)]
                    size = min(n, len(found))
                    for k in range(len(found) - size + 1 if size else 0):
                        out.append((size, b" ".join(found[k : k + size]), ids[run.lo + i].as_py()))
            sizes, windows, owners = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes, pa.int32()), pa.array(windows, pa.binary()), pa.array(owners, pa.string())],
                ["size", "window", "item"],
            )

    rows = items.select(F.col("item_id").cast("string"), F.col("text"))
    rows = rows.mapInArrow(cut, "size INT, window BINARY, item STRING")
    return rows.distinct()


class _Set:
    """A block of windows, by size: bitmap, sorted hashes, and the windows."""

    def __init__(self, rows):
        self.by_size = {}
        for size in sorted({r[0] for r in rows}):
            own = [(bytes(window), item) for n, window, item in rows if n == size]
            table = {}
            for run in words_of.words(pa.array([w.decode() for w, _ in own], pa.string()), words_of.ALNUM):
                # A window has exactly ``size`` words, so each begins where the one before ends.
                hashes = words_of.runs(run.hashes, size)[:: size]
                for (window, item), h in zip(own[run.lo :], hashes.tolist()):
                    table.setdefault(h, {}).setdefault(window, []).append(item)
            hashes = np.array(sorted(table), np.uint64)
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.by_size[size] = (bitmap, hashes, table)

    @property
    def longest(self) -> int:
        return max(self.by_size, default=1)

    def find(self, run: words_of.Words) -> Iterator[tuple[int, int, list[str]]]:
        """Verified (first word, size, items), words counted over the run."""
        for size, (bitmap, hashes, table) in self.by_size.items():
            of = words_of.runs(run.hashes, size)
            at = np.flatnonzero(bitmap[(of >> np.uint64(64 - _BITS)).astype(np.int64)])
            near = np.minimum(np.searchsorted(hashes, of[at]), len(hashes) - 1)
            at = at[hashes[near] == of[at]]
            # A run of words must not pass the end of its text.
            own_end = run.first[np.searchsorted(run.first, at, side="right")]
            for k in at[at + size <= own_end].tolist():
                window = b" ".join(run.word(i) for i in range(k, k + size))
                items = table[int(of[k])].get(window)
                if items:
                    yield k, size, items


def _merge(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(pairs):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _scan_block(docs: DataFrame, shared, text: str) -> DataFrame:
    """Add a block's finds to the three columns that carry hits."""
    schema = docs.schema
    added = {_FOUND[0]: T.ArrayType(T.LongType()), _FOUND[1]: T.ArrayType(T.LongType())}
    added |= {_FOUND[2]: T.ArrayType(T.StringType()), "n_words": T.LongType()}
    new = [T.StructField(name, kind) for name, kind in added.items() if name not in docs.columns]
    schema = T.StructType([*schema.fields, *new])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            n = batch.num_rows
            spans = [[] for _ in range(n)]
            items = [set() for _ in range(n)]
            counts = np.zeros(n, np.int64)
            if _FOUND[0] in batch.schema.names:
                for i, (lo, hi, got) in enumerate(zip(*(batch.column(c).to_pylist() for c in _FOUND))):
                    spans[i], items[i] = list(zip(lo, hi)), set(got)
            for run in words_of.word_pieces(batch.column(text), words_of.ALNUM, block.longest - 1):
                # Words of the same text before this piece; more than none only for the later pieces of a long one.
                before = int(counts[run.lo]) - run.carried
                for k, size, owners in block.find(run):
                    i = int(np.searchsorted(run.first, k, side="right")) - 1
                    at = k - int(run.first[i]) + before
                    spans[run.lo + i].append((at, at + size))
                    items[run.lo + i].update(o for o in owners if o is not None)
                counts[run.lo : run.lo + len(run.first) - 1] += np.diff(run.first)
                counts[run.lo] -= run.carried
            spans = [_merge(s) if s else s for s in spans]
            made = {
                _FOUND[0]: pa.array([[lo for lo, _ in s] for s in spans], pa.list_(pa.int64())),
                _FOUND[1]: pa.array([[hi for _, hi in s] for s in spans], pa.list_(pa.int64())),
                _FOUND[2]: pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                "n_words": pa.array(counts),
            }
            yield pa.RecordBatch.from_arrays(
                [made[f.name] if f.name in made else batch.column(f.name) for f in schema.fields],
                [f.name for f in schema.fields],
            )

    return docs.mapInArrow(scan, schema)


def _blocks(items: DataFrame, n: int):
    windows = staged(benchmark_windows(items, n), "benchmark-windows")
    parts = max(1, -(-windows.count() // BLOCK_WINDOWS))
    for k in range(parts):
        own = windows.where(F.pmod(F.xxhash64("window", "item"), F.lit(parts)) == k) if parts > 1 else windows
        yield items.sparkSession.sparkContext.broadcast(_Set([tuple(r) for r in own.collect()])), k == parts - 1


def _judged(docs: DataFrame, items: DataFrame, n: int, text: str) -> DataFrame:
    found = docs
    for shared, last in _blocks(items, n):
        found = _scan_block(found, shared, text)
        if not last:
            found = staged(found, "benchmark-hits")
    return found


def scan(docs: DataFrame, items: DataFrame, n: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items, hit_from, hit_to)`` per
    document; hits are word positions, the end excluded."""
    found = _judged(docs.select(key, text), items, n, text)
    hit = F.aggregate(
        F.zip_with(_FOUND[0], _FOUND[1], lambda lo, hi: hi - lo), F.lit(0).cast("bigint"), lambda a, x: a + x
    )
    return found.select(
        key,
        "n_words",
        hit.alias("n_hit"),
        F.size(_FOUND[2]).cast("bigint").alias("n_items"),
        F.col(_FOUND[2]).alias("items"),
        F.col(_FOUND[0]).alias("hit_from"),
        F.col(_FOUND[1]).alias("hit_to"),
    )


def clean(docs: DataFrame, items: DataFrame, n: int = WINDOW, spans: bool = False, text: str = "text") -> DataFrame:
    """``docs`` without contaminated documents, or with ``spans`` all documents
    without the bytes from the first to the last word of each hit run."""
    narrow = docs.withColumnsRenamed({c: f"_kept_{c}" for c in (*_FOUND, "n_words") if c in docs.columns})
    found = _judged(narrow, items, n, text)
    back = {f"_kept_{c}": c for c in (*_FOUND, "n_words") if c in docs.columns}
    if not spans:
        kept = found.where(F.size(_FOUND[0]) == 0)
        return kept.drop(*_FOUND, "n_words").withColumnsRenamed(back).select(*docs.columns)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        column = pa.array(texts, pa.string())
        raw, bounds = words_of.buffers(column)
        out = list(texts)
        for run in words_of.words(column, words_of.ALNUM):
            for i in range(len(run.first) - 1):
                if len(starts[run.lo + i]):
                    base, at, parts = run.first[i], int(bounds[run.lo + i]), []
                    shift = at - int(run.bounds[i])
                    for lo, hi in zip(starts[run.lo + i], ends[run.lo + i]):
                        parts.append(raw[at : int(run.starts[base + lo]) + shift].tobytes())
                        at = int(run.ends[base + hi - 1]) + shift
                    parts.append(raw[at : int(bounds[run.lo + i + 1])].tobytes())
                    out[run.lo + i] = b"".join(parts).decode()
        return pd.Series(out)

    made = found.withColumn(text, F.when(F.size(_FOUND[0]) > 0, cut(text, _FOUND[0], _FOUND[1])).otherwise(F.col(text)))
    return made.drop(*_FOUND, "n_words").withColumnsRenamed(back).select(*docs.columns)

