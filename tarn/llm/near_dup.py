"""Near-duplicate documents by circulant MinHash.

A document is the set of its five-word shingles. One permutation places the
shingles on a ring; a second one gives the ring its values, and coordinate ``k`` of
the signature is the smallest value when the ring is shifted by ``k``. So the
values of a shingle for all coordinates are one slice of a table. Bands of
coordinates are buckets, and documents that share a bucket are candidates.

Equal sets are one node from the start, so copies are never compared. Pairs are
never listed within a bucket. Instead:

1. every member of a bucket is compared with the bucket's pivot, the member that
   shares most buckets with others; true links make components;
2. what could still be linked stands in buckets of several components. Members
   are grouped under their pivot, large groups are split into tiles, and each pair
   of tiles compares, on full sets, the pairs from different components. That is
   exact, bounded in memory, and has no partner or candidate limit.

All links are confirmed on full sets: 100 * intersection >= similar * union, where
``similar`` is 85 unless stated. The bands follow from it: at that similarity, the
chance that two sets share no bucket is below one in a million.

Defined cases: a document without words, or null, has an empty set and is linked
with nothing; with fewer than five words the whole sequence is one shingle;
rows that repeat a ``doc_id`` are judged each by its text; ids that are null are the last
choice for ``component_id`` and are kept only if alone; an empty table gives no
row; a very long text is read in pieces, and only its set, 8 bytes for each
distinct shingle, is held whole; further columns are ignored by ``link`` and kept by ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.llm import text as words_of
from tarn.llm.columns import place, restored, sheltered
from tarn.llm.components import components
from tarn.session import staged

SHINGLE = 5
SIMILAR = 85
COORDINATES = 192
#: The chance to share no bucket is lower, at the similarity asked for.
MISSED = 1e-6
RING_BITS = 20
#: Bytes of full sets sent on together, but for one larger set.
SET_BYTES = 8 << 20
#: Nodes in a tile of the exact round.
TILE = 1024

_SALTS = np.array([0x51ED270B90D3A1C7, 0x2545F4914F6CDD1D], np.uint64)
_made: dict[str, np.ndarray] = {}


def bands_for(similar: int) -> tuple[int, int]:
    """How many bands of how many rows: the longest bands that keep to ``MISSED``."""
    for rows in range(COORDINATES, 0, -1):
        bands = COORDINATES // rows
        if 0 < similar <= 100 and (1 - (similar / 100) ** rows) ** bands < MISSED:
            return bands, rows
    raise ValueError(f"no bands for a similarity of {similar} in 100")


def agree_for(similar: int) -> float:
    """Pairs whose signatures agree less are left out of the tiles: five standard errors below the threshold."""
    s = similar / 100
    return math.floor(100 * (s - 5 * math.sqrt(s * (1 - s) / COORDINATES))) / 100


def _ring() -> np.ndarray:
    """Row ``p`` holds the values of ring place ``p`` for all coordinates; the
    rows are overlapping slices of one table."""
    if "ring" not in _made:
        values = np.random.default_rng(20).permutation(1 << RING_BITS).astype(np.uint32)
        values = np.concatenate([values, values[:COORDINATES]])
        _made["ring"] = np.lib.stride_tricks.sliding_window_view(values, COORDINATES)
    return _made["ring"]


def signature(shingles: np.ndarray) -> np.ndarray:
    best = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(shingles), 256):
        places = (shingles[k : k + 256] >> np.uint64(64 - RING_BITS)).astype(np.int64)
        np.minimum(best, _ring()[places].min(axis=0), out=best)
    return best


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band and document, different for each band."""
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows).astype(np.uint64)
    total = np.arange(bands, dtype=np.uint64)[None, :] + np.uint64(1)
    for j in range(rows):
        total = words_of.mix(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return total.view(np.int64)


def node_key(shingles: np.ndarray) -> bytes:
    """128 bits that name a set."""
    total = np.zeros(len(_SALTS), np.uint64)
    for k in range(0, len(shingles), 1 << 16):
        block = shingles[k : k + (1 << 16)]
        total += np.array([words_of.mix(block ^ salt).sum(dtype=np.uint64) for salt in _SALTS])
    return total.tobytes()


def _united(sets: list[np.ndarray]) -> np.ndarray:
    """The union of sorted sets; the list is emptied, so that little is held twice."""
    if len(sets) == 1:
        return sets.pop()
    every = np.concatenate(sets)
    sets.clear()
    every.sort()
    return every[np.concatenate([[True], every[1:] != every[:-1]])]


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Index and sorted distinct shingle hashes of each text with words."""
    earlier: list[np.ndarray] = []
    for run in words_of.word_pieces(column, words_of.NON_SPACE, SHINGLE - 1):
        hashes = words_of.runs(run.hashes, SHINGLE)
        for i in range(len(run.first) - 1):
            lo, hi = run.first[i], run.first[i + 1]
            if hi - lo >= SHINGLE:
                earlier.append(np.unique(hashes[lo : hi - SHINGLE + 1]))
            elif hi > lo and not earlier and not run.goes_on:
                earlier.append(np.array([words_of.run_of(run.hashes[lo:hi])], np.uint64))
            if earlier and not run.goes_on:
                yield run.lo + i, _united(earlier)


def _sketch(bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sizes, nodes = np.zeros(n, np.int64), [None] * n
            signatures = np.zeros((n, COORDINATES), np.uint32)
            for i, shingles in shingle_sets(batch.column(1)):
                sizes[i], nodes[i] = len(shingles), node_key(shingles)
                signatures[i] = signature(shingles)
            keys = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(band_keys(signatures, bands, rows).ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.binary()), pa.array(sizes), keys, batch.column(2)],
                ["doc_id", "node", "n", "bands", "text_hash"],
            )

    return sketch


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.binary(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["node", "n", "shingles", "signature"])

    for batch in batches:
        rows, held = [], 0
        for _, s in shingle_sets(batch.column(0)):
            rows.append((node_key(s), len(s), s.tobytes(), signature(s).tobytes()))
            held += s.nbytes
            if len(rows) == 500 or held > SET_BYTES:
                yield made(rows)
                rows, held = [], 0
        if rows:
            yield made(rows)


def _is_link(common: np.ndarray, a, b, similar: int) -> np.ndarray:
    return 100 * common >= similar * (a + b - common)


def _linked(similar: int):
    @F.arrow_udf(T.BooleanType())
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(left, right):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            near = np.minimum(np.searchsorted(b, a), len(b) - 1)
            out.append(bool(_is_link(np.count_nonzero(b[near] == a), len(a), len(b), similar)))
        return pa.array(out, pa.bool_())

    return linked


def _tile_links(frame: pd.DataFrame, similar: int) -> pd.DataFrame:
    """Links between nodes of different components of one tile, or of two: for
    each pair of components that get joined, one."""
    frame = frame.sort_values("node").reset_index(drop=True)
    agree = agree_for(similar) * COORDINATES
    two = frame["a"].iloc[0] != frame["b"].iloc[0]
    salt, n = frame["salt"].to_numpy(), frame["n"].to_numpy()
    root, comp = pd.factorize(frame["comp"])[0], {}
    signatures = np.stack([np.frombuffer(s, np.uint32) for s in frame["signature"]])
    sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
    universe, dense = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    flags = np.zeros(len(universe), np.int64)

    def find(c: int) -> int:
        while comp.get(c, c) != c:
            c = comp[c]
        return c

    out = []
    for x in range(len(frame)):
        later = np.arange(x + 1, len(frame))
        fits = (root[later] != root[x]) & (100 * np.minimum(n[later], n[x]) >= similar * np.maximum(n[later], n[x]))
        if two:
            fits &= salt[later] != salt[x]
        later = later[fits]
        if len(later):
            later = later[(signatures[later] == signatures[x]).sum(axis=1) >= agree]
        if not len(later):
            continue
        own = dense[bounds[x] : bounds[x + 1]]
        flags[own] = 1
        for y in later.tolist():
            cx, cy = find(int(root[x])), find(int(root[y]))
            if cx != cy and _is_link(flags[dense[bounds[y] : bounds[y + 1]]].sum(), n[x], n[y], similar):
                comp[cx] = cy
                out.append((frame["node"][x], frame["node"][y]))
        flags[own] = 0
    return pd.DataFrame(out, columns=["a", "b"])


def _pivot_links(members: DataFrame, sets: DataFrame, similar: int) -> tuple[DataFrame, DataFrame]:
    """(node, pivot) for all members of buckets, and the links among them."""
    score = members.groupBy("node").agg(F.sum("size").alias("score"))
    scored = members.join(score, "node")
    pivot = scored.groupBy("bucket").agg(F.max(F.struct("score", "node")).alias("p"))
    pairs = scored.join(pivot.select("bucket", F.col("p.node").alias("pivot")), "bucket")
    pairs = staged(pairs.select("node", "pivot").distinct(), "near-pairs")
    full = sets.select("node", "n", "shingles")
    other = full.select(F.col("node").alias("pivot"), F.col("n").alias("pivot_n"), F.col("shingles").alias("pivot_shingles"))
    fits = 100 * F.least("n", "pivot_n") >= similar * F.greatest("n", "pivot_n")
    sizes = sets.select("node", "n")
    tested = pairs.where(F.col("node") != F.col("pivot")).join(sizes, "node").join(sizes.select(F.col("node").alias("pivot"), F.col("n").alias("pivot_n")), "pivot")
    tested = tested.where(fits).select("node", "pivot")
    verified = tested.join(full, "node").join(other, "pivot").where(_linked(similar)("shingles", "pivot_shingles"))
    return pairs, staged(verified.select(F.col("node").alias("a"), F.col("pivot").alias("b")), "near-links")


def _cross_links(pairs: DataFrame, found: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Exact links between different components, from tiles of pivot groups."""
    grouped = pairs.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    live = grouped.groupBy("pivot").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"))
    live = live.where(F.col("lo") != F.col("hi")).select("pivot", F.ceil(F.col("m") / TILE).cast("int").alias("tiles"))
    rows = grouped.join(live, "pivot").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select(
        "pivot", F.least("salt", "other").alias("a"), F.greatest("salt", "other").alias("b"), "salt", "node", "comp"
    )
    rows = rows.join(sets, "node")
    tile = lambda frame: _tile_links(frame, similar)
    return staged(rows.groupBy("pivot", "a", "b").applyInPandas(tile, "a BINARY, b BINARY"), "near-cross")


def link(docs: DataFrame, text: str = "text", key: str = "doc_id", similar: int = SIMILAR) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, comp, text_hash)`` per document;
    ``comp`` names its component, also where ids repeat. Sets are linked that have
    ``similar`` of 100 shingles in common, or more."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = "doc_id BIGINT, node BINARY, n BIGINT, bands ARRAY<BIGINT>, text_hash BIGINT"
    sketch = staged(rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_sketch(*bands_for(similar)), schema), "near-sketch")
    # Copies of a set fall together before anything is counted.
    nodes = sketch.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    nodes = staged(nodes, "near-nodes")
    spread = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = spread.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = staged(spread.join(sizes, "bucket"), "near-members")
    firsts = staged(nodes.select("node", F.col("first_id").alias("_first")).join(members.select("node").distinct(), "node"), "near-firsts")
    wanted = rows.join(firsts.select("_first").distinct(), F.col("doc_id").eqNullSafe(F.col("_first")), "left_semi")
    full = wanted.select("text").mapInArrow(_full_sets, "node BINARY, n BIGINT, shingles BINARY, signature BINARY")
    sets = full.join(firsts.select("node"), "node", "left_semi").dropDuplicates(["node"])
    sets = staged(sets, "near-sets")
    pairs, links = _pivot_links(members, sets, similar)
    found = components(links)
    cross = _cross_links(pairs, found, sets, similar)
    if not cross.isEmpty():
        found = components(links.unionByName(cross))
    comp = F.coalesce("comp", "node")
    placed = sketch.select("doc_id", "node", "n", "text_hash").join(found, "node", "left").withColumn("comp", comp)
    smallest = placed.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("smallest"))
    placed = placed.join(smallest, "comp", "left")
    component = F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    return placed.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "comp",
        "text_hash",
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", similar: int = SIMILAR) -> DataFrame:
    """``docs`` with one document of each component, its first; one row of it, if
    rows repeat. Documents without words stay, but for repeated rows."""
    kept = link(docs, text, key, similar).where("kept")
    chosen = kept.groupBy("doc_id", "comp").agg(F.min("text_hash").alias("_hash")).select(F.col("doc_id").alias("_id"), "_hash")
    own_key, own_text = place(docs, key), place(docs, text)
    rows = sheltered(docs).withColumn("_text_hash", F.xxhash64(F.coalesce(F.col(own_text), F.lit(""))))
    same = F.col(own_key).cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    return restored(rows.join(chosen, same, "left_semi").dropDuplicates([own_key, "_text_hash"]), docs)
