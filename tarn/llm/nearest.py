"""Nearest vectors by inner product with multiprobe p-stable hashing.

Vectors are scaled by the largest norm and get one more component that makes all
norms 1; queries are scaled to norm 1 with a 0 there. So the largest inner product
is the smallest Euclidean distance, which p-stable (Gaussian) projections, cut into
cells, preserve. A table's bucket is the cell vector of ``FUNCTIONS`` projections.
A query visits, in each of ``TABLES`` tables, its own bucket and then perturbed ones
in order of their expected chance to hold a near vector, which follows from how near
the query lies to the borders of its cells. Candidates of all tables are merged,
ranked by single-precision products, and the best are scored again exactly.

How many buckets are visited is measured: for ``SAMPLE_QUERIES`` queries of the
smallest hash, the true nearest of all vectors are found and the visit that would
reach each; enough visits are made that ``REACH`` of these queries reach ``REACH`` of
their own nearest. Where ``MOST_VISITS`` are too few for that, all vectors are
compared. On data without neighbourhoods that is most buckets; on clustered data it
is few. A query that still finds fewer than ``k``, though there are more, is compared
with all vectors: its buckets say nothing, as when one long vector puts all others
into nearly one bucket.

Where the sample's queries meet less than ``LOOKUP_PART`` of all vectors in their
buckets, the visits are joined with the indexed vectors by bucket. Small buckets share
parts, each query and vector is sent once to a part that it meets, and a larger bucket
is cut into blocks of queries and tiles of vectors, so no bucket is ever gathered.
Otherwise (where visits cover more, and for queries left short) blocks of queries meet
all tiles of vectors, dealt by hash. Both ways compare the same pairs. A part returns ``k`` vectors for each of its queries, never pairs.
Equal vectors are one row with their smallest ids, as no result needs more of them.

Defined cases: vectors that are null, zero, or hold null or non-finite components,
and those whose length is not the commonest one, take no part; ties go to the
smaller id; rows that repeat an id count once for each distinct vector; a query
with fewer candidates gets all there are; an empty table gives no row; further
columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarn.session import measured, staged

TABLES, FUNCTIONS, CELL = 6, 10, 3.0
MOST_VISITS = 1500
SAMPLE_QUERIES, REACH = 100, 0.95
BLOCK_QUERIES, TILE_VALUES = 1024, 1 << 19
#: Buckets are looked up where that compares less than this part of all pairs.
LOOKUP_PART = 0.25
#: A bucket with more than a block or a tile over this is cut up, not put into a shared part.
PART_BUCKETS = 8

_FOUND = "query_id BIGINT, vec_id BIGINT, score DOUBLE"


def visits(functions: int, limit: int) -> np.ndarray:
    """Which borders each visit crosses, of ``2 * functions`` borders sorted by
    their distance; visits come in order of the expected sum of squared distances."""
    m = functions
    near = lambda j: j * (j + 1) / (4 * (m + 1) * (m + 2))
    far = lambda j: 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
    cost = [near(j) if j <= m else far(j) for j in range(1, 2 * m + 1)]
    found, heap = [()], [(cost[0], (0,))]
    while heap and len(found) < limit:
        total, crossed = heapq.heappop(heap)
        # The nearest border's opposite is the farthest one: not both can be crossed.
        if not any(2 * m - 1 - j in crossed for j in crossed):
            found.append(crossed)
        last = crossed[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total + cost[last + 1], (*crossed, last + 1)))
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*crossed[:-1], last + 1)))
    out = np.zeros((len(found), 2 * m), np.int64)
    for i, crossed in enumerate(found):
        out[i, list(crossed)] = 1
    return out


class Hashing:
    """The tables' projections, for vectors of one length and a largest norm."""

    def __init__(self, size: int, norm: float):
        rng = np.random.default_rng(11)
        self.norm = norm
        self.lines = rng.normal(size=(TABLES, size + 1, FUNCTIONS))
        self.shift = rng.random((TABLES, FUNCTIONS)) * CELL
        self.factor = rng.integers(1, 1 << 62, FUNCTIONS) * 2 + 1
        self.order = visits(FUNCTIONS, MOST_VISITS)

    def _cells(self, x: np.ndarray, t: int) -> np.ndarray:
        return (x @ self.lines[t] + self.shift[t]) / CELL

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """(tables, rows): the bucket of each indexed vector."""
        scaled = x / self.norm
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1, keepdims=True)))
        full = np.concatenate([scaled, rest], axis=1)
        return np.stack([np.floor(self._cells(full, t)).astype(np.int64) @ self.factor for t in range(TABLES)])

    def probes(self, q: np.ndarray, count: int) -> np.ndarray:
        """(tables, count): the buckets one query visits, in order."""
        full = np.append(q / np.sqrt((q * q).sum()), 0.0)
        order = self.order[:count]
        out = np.empty((TABLES, len(order)), np.int64)
        for t in range(TABLES):
            at = self._cells(full, t)
            cell = np.floor(at)
            down = at - cell
            rank = np.argsort(np.concatenate([down, 1 - down]))
            # Crossing the lower border of a cell takes 1 from its number, the upper adds 1.
            change = np.where(rank < FUNCTIONS, -1, 1) * self.factor[rank % FUNCTIONS]
            out[t] = cell.astype(np.int64) @ self.factor + order @ change
        return out


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component on."""
    total = np.zeros(len(x))
    for j in range(len(q)):
        total += q[j] * x[:, j]
    return total


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _single(x: np.ndarray) -> np.ndarray:
    """In single precision, scaled so that no vector is longer than 1."""
    largest = np.abs(x).max(initial=0.0) or 1.0
    x = x / largest
    return (x / np.sqrt((x * x).sum(axis=1)).max(initial=1.0)).astype(np.float32)


def _best(own: int, q: np.ndarray, x: np.ndarray, x32: np.ndarray, at: np.ndarray, ids: list, k: int):
    """The ``k`` best (score, id) of the vectors ``at``, the query's own id left out.

    Products in single precision pick those that are scored exactly. Of vectors no
    longer than 1 they err by at most half of ``margin``, which therefore keeps every
    vector that may be among the best."""
    if not len(at):
        return []
    rough, cut = x32[at] @ _single(q[None])[0], k + 1
    margin = (len(q) + 3) * 2.0**-22
    while True:
        near = at
        if len(at) > cut:
            edge = np.partition(rough, -cut)[-cut]
            near = at[rough >= edge - margin]
        best: dict = {}
        for s, a in zip(exact(q, x[near]).tolist(), near.tolist()):
            for i in ids[a]:
                if i != own:
                    best[i] = max(s, best.get(i, s))
        # Ids that repeat with several vectors take several of the cut's places.
        if len(best) >= k or len(near) == len(at):
            return [(i, -s) for s, i in heapq.nsmallest(k, [(-s, i) for i, s in best.items()])]
        cut *= 4


def _found(rows: list) -> pa.RecordBatch:
    ids, vecs, scores = zip(*rows) if rows else ((), (), ())
    kinds = (pa.int64(), pa.int64(), pa.float64())
    arrays = [pa.array(c, t) for c, t in zip((ids, vecs, scores), kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])


def _search(hashing, count: int | None, k: int):
    """Compares each query with the vectors of its first ``count`` buckets; with all, if None."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list = []
        if left.num_rows and right.num_rows:
            h = hashing.value
            x, ids = _matrix(right["v"]), right["ids"].to_pylist()
            x32 = _single(x)
            cut = [np.unique(b, return_inverse=True) for b in h.buckets(x)] if count else []
            for own, q in zip(left["query_id"].to_pylist(), _matrix(left["v"])):
                seen = np.full(len(x), not count)
                for probed, (buckets, place) in zip(h.probes(q, count) if count else (), cut):
                    seen |= np.isin(buckets, probed)[place]
                rows += [(own, i, s) for i, s in _best(own, q, x, x32, np.flatnonzero(seen), ids, k)]
        return pa.Table.from_batches([_found(rows)])

    return search


def _visits_needed(index: DataFrame, sample: list, hashing, k: int) -> int | None:
    """Visits after which ``REACH`` of the sample's queries have reached ``REACH`` of
    their own true nearest; None, if ``MOST_VISITS`` do not do."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = hashing.value
        probes = [h.probes(q, MOST_VISITS) for _, q in sample]
        for batch in batches:
            x, ids = _matrix(batch.column("v")), batch.column("ids").to_pylist()
            if not len(x):
                continue
            x32, everything = _single(x), np.arange(len(x))
            buckets, out = h.buckets(x), []
            home = {i: a for a, own in enumerate(ids) for i in own}
            for (own, q), probed in zip(sample, probes):
                for i, s in _best(own, q, x, x32, everything, ids, k):
                    first = [np.flatnonzero(probed[t] == buckets[t, home[i]])[:1] for t in range(TABLES)]
                    reached = min((int(f[0]) + 1 for f in first if len(f)), default=MOST_VISITS + 1)
                    out.append((own, s, i, reached))
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "score", "vec_id", "reached"]
            )

    found = index.mapInArrow(rank, "query_id BIGINT, score DOUBLE, vec_id BIGINT, reached BIGINT")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    reached: dict = {}
    for own, visit in found.select("query_id", "reached").collect():
        reached.setdefault(own, []).append(visit)
    count = _reach([_reach(r) for r in reached.values()]) if reached else 1
    return count if count <= MOST_VISITS else None


def _reach(visits: list[int]) -> int:
    """The smallest of the numbers that ``REACH`` of them do not exceed."""
    return sorted(visits)[math.ceil(len(visits) * REACH - 1e-9) - 1]


def _valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col("v")
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return rows.where(F.col("id").isNotNull() & finite & F.exists(v, lambda c: c != 0))


def nearest(vectors: DataFrame, asks: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each row for
    which ``asks`` (a condition on ``id``) holds."""
    spark = vectors.sparkSession
    rows = _valid(vectors, key, vector)
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    size = int(common[0]) if common else 1
    rows = rows.where(F.size("v") == size).distinct()
    same = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("k", F.row_number().over(same)).where(F.col("k") <= k + 1)
    index = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    # Written with the rows, the number of a row stays the same in every later scan.
    numbered = F.monotonically_increasing_id().alias("row")
    index = staged(index.select(numbered, "ids", "v"), "nearest-index")
    asked = staged(rows.where(asks).select(F.col("id").alias("query_id"), "v").select(numbered, "query_id", "v"), "nearest-queries")
    squares = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    n, norm = index.agg(F.count("*"), F.sqrt(F.max(squares))).first()
    sample = asked.orderBy(F.xxhash64("query_id"), "query_id", "v").limit(SAMPLE_QUERIES).collect()
    sample = [(r["query_id"], np.array(r["v"])) for r in sample]
    hashing = spark.sparkContext.broadcast(Hashing(size, float(norm or 1.0)))
    count = _visits_needed(index, sample, hashing, k)
    tile = max(256, TILE_VALUES // size)
    tiles = max(1, -(-n // tile))
    if count and _part_met(index, sample, hashing, count) < LOOKUP_PART:
        found = _looked_up(asked, index, tile, hashing, count, k)
    else:
        found = _compared(asked, index, tiles, _search(hashing, count, k), k)
    if count:
        # Each query's own id is one of all ids.
        wanted = min(k, index.select(F.explode("ids").alias("id")).distinct().count() - 1)
        found = staged(found, "nearest-found")
        full = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= wanted).select("query_id")
        short = staged(asked.join(full, "query_id", "left_anti"), "nearest-short")
        if wanted > 0 and not short.isEmpty():
            again = _compared(short, index, tiles, _search(hashing, None, k), k)
            found = found.join(full, "query_id", "left_semi").unionByName(again)
    return found


def _compared(asked: DataFrame, index: DataFrame, tiles: int, search, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` after blocks of queries have met all tiles of vectors."""
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    over = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("tile", over(tiles))
    right = index.withColumn("tile", F.pmod(F.xxhash64("v"), F.lit(tiles)).cast("int")).withColumn("block", over(blocks))
    pairs = left.groupBy("block", "tile").cogroup(right.groupBy("block", "tile"))
    return _ranked(pairs.applyInArrow(search, _FOUND), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # Rows that repeat an id with several vectors may find a candidate twice.
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _codes(hashing, count: int | None):
    """``(row, code)``: the buckets of each vector, or those that a query visits."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, table = hashing.value, np.arange(TABLES)[:, None]
        for batch in batches:
            x, row = _matrix(batch.column("v")), batch.column("row").to_numpy()
            if not len(x):
                continue
            if count is None:
                # Equal codes of two tables would only add candidates.
                found = [(row[i : i + 1], b) for i, b in enumerate((h.buckets(x) * TABLES + table).T)]
            else:
                found = [(row[i : i + 1], np.unique(h.probes(q, count) * TABLES + table)) for i, q in enumerate(x)]
            rows = np.concatenate([np.repeat(r, len(b)) for r, b in found])
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.concatenate([b for _, b in found]))], ["row", "code"])

    return code


def _met(k: int):
    """Compares each query of a part with the vectors there whose buckets it visits."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list = []
        if left.num_rows and right.num_rows:
            x, ids = _matrix(right["v"]), right["ids"].to_pylist()
            x32, codes = _single(x), right["codes"].combine_chunks()
            held, home = codes.flatten().to_numpy(), codes.value_parent_indices().to_numpy()
            order = np.argsort(held, kind="stable")
            held, home = held[order], home[order]
            visited = left["codes"].combine_chunks()
            for own, q, wanted in zip(left["query_id"].to_pylist(), _matrix(left["v"]), visited):
                wanted = wanted.values.to_numpy()
                lo, hi = np.searchsorted(held, wanted), np.searchsorted(held, wanted, "right")
                at = [home[a:b] for a, b in zip(lo, hi) if a < b]
                rows += [(own, i, s) for i, s in _best(own, q, x, x32, np.unique(np.concatenate(at)), ids, k)] if at else []
        return pa.Table.from_batches([_found(rows)])

    return search


def _part_met(index: DataFrame, sample: list, hashing, count: int) -> float:
    """Vectors in the buckets that a query of the sample visits, once for each table, as a part of all."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = hashing.value
        probes = [h.probes(q, count) for _, q in sample]
        for batch in batches:
            x = _matrix(batch.column("v"))
            if len(x):
                made = [np.unique(b, return_counts=True) for b in h.buckets(x)]
                pairs = sum(int(c[np.isin(b, p[t])].sum()) for p in probes for t, (b, c) in enumerate(made))
                yield pa.RecordBatch.from_arrays([pa.array([pairs]), pa.array([len(x)])], ["pairs", "n"])

    pairs, n = index.select("v").mapInArrow(met, "pairs BIGINT, n BIGINT").agg(F.sum("pairs"), F.sum("n")).first()
    return (pairs or 0) / max(1, (n or 0) * len(sample))


def _looked_up(asked: DataFrame, index: DataFrame, tile: int, hashing, count: int, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of a join by bucket."""
    codes = lambda df, visits: df.select("row", "v").mapInArrow(_codes(hashing, visits), "row BIGINT, code BIGINT")
    entries = staged(codes(index, None), "nearest-entries")
    probes = staged(codes(asked, count), "nearest-probes")
    number = lambda df, name: df.groupBy("code").agg(F.count("*").alias(name))
    met = staged(number(entries, "vectors").join(number(probes, "queries"), "code"), "nearest-met")
    most, block = max(1, tile // PART_BUCKETS), max(1, BLOCK_QUERIES // PART_BUCKETS)
    large = (F.col("vectors") > most) | (F.col("queries") > block)
    over = lambda name, most: F.ceil(F.col(name) / most).cast("int")
    cut = met.where(large).select("code", over("vectors", tile).alias("tiles"), over("queries", BLOCK_QUERIES).alias("blocks"))
    cut, _ = measured(cut, "nearest-cut")
    shared = met.where(~large)
    total = shared.agg(F.sum("vectors"), F.sum("queries")).first()
    parts = max(1, *(-(-int(got or 0) // most) for got, most in zip(total, (tile, BLOCK_QUERIES))))

    def placed(keys: DataFrame, own: str, other: str) -> DataFrame:
        """``(row, part, block, tile, codes)``: where each row goes, once for each place."""
        dealt = {"tile": "tiles", "block": "blocks"}
        joined = keys.join(cut, "code", "left")
        split = joined.where("tiles IS NOT NULL")
        split = split.withColumn(own, F.pmod(F.xxhash64("row"), F.col(dealt[own])).cast("int"))
        split = split.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(dealt[other]) - 1)))
        few = joined.where("tiles IS NULL").join(shared, "code", "left_semi")
        few = few.withColumn("part", F.pmod(F.xxhash64("code"), F.lit(parts)))
        # A tile of -1 marks the shared parts.
        few = few.groupBy("row", "part").agg(F.collect_list("code").alias("codes")).select(
            "row", "part", F.lit(0).alias("block"), F.lit(-1).alias("tile"), "codes"
        )
        split = split.select("row", F.col("code").alias("part"), "block", "tile", F.array("code").alias("codes"))
        return few.unionByName(split)

    place = ["part", "block", "tile"]
    left = placed(probes, "block", "tile").join(asked, "row").select(*place, "codes", "query_id", "v")
    right = placed(entries, "tile", "block").join(index, "row").select(*place, "codes", "ids", "v")
    return _ranked(left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(_met(k), _FOUND), k)
