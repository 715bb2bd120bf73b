"""Importance resampling towards a target distribution, by hashed n-grams.

Runs of 1 to ``longest`` consecutive words are features, and each falls in one of ``buckets`` by its CRC-32. A bucket's gain is the
log ratio, in thousandths, of its smoothed shares in the target texts and in all documents; a document's weight is the
floored mean of its features' gains. Gumbel noise from a hash of the id is added, and the documents with the highest
scores are drawn, which samples without replacement in proportion to the weights' exponentials.

Texts are taken in pieces of bounded size. The features of a piece are interned in a numpy table with open addressing: keys
are xxhash64 of the feature's bytes, and an occurrence ends its probes only at a slot whose owner has the same bytes. A
slot stores the feature's bucket and its count, so the CRC is taken once per different feature; counts are added up by bucket,
and gains are gathered through the slot ids of the occurrences.

The gains are one number per bucket, so they are sent to all tasks. Ranks come from a histogram of scores, which
are whole numbers of a bounded range: it gives the lowest score that is drawn, and only rows from there on are
sorted, over range partitions.

Defined cases: a null or empty text has no features and weight 0; rows without id take their noise from an empty
id, and go last among equal scores; rows that repeat an id are each scored, and equal ones rank in order of ``n_features``, then in any order;
without documents there is no row, without target texts every gain comes from the documents alone;
columns ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` of the input are replaced (whatever the case of their letters), other
columns are kept, and the text is left out; texts of any length are taken whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.llm import text as words_of
from tarn.llm.columns import place, sheltered
from tarn.session import staged

BUCKETS = 10_000
LONGEST = 1
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
ADDED = ("n_words", "n_features", "weight", "score", "rank")

# The five primes of the 64-bit xxHash.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
#: Bytes behind the text of a piece, so that whole lanes can be read.
_PAD = 32


def _rotated(x: np.ndarray, n: int) -> np.ndarray:
    return x << np.uint64(n) | x >> np.uint64(64 - n)


def _lanes(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Little-endian numbers of 8 or 4 bytes at any places."""
    return data[at[:, None] + np.arange(width)].view("<u8" if width == 8 else "<u4")[:, 0].astype(np.uint64)


def xxhash64(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of slices of ``data``, which is padded. Slices under 32 bytes, nearly all words, are
    hashed together; longer ones one by one."""
    total = _P5 + sizes.astype(np.uint64)
    short = sizes < 32
    for k in range(3):
        at = np.flatnonzero(short & (sizes >= 8 * (k + 1)))
        lane = _rotated(_lanes(data, starts[at] + 8 * k, 8) * _P2, 31) * _P1
        total[at] = _rotated(total[at] ^ lane, 27) * _P1 + _P4
    rest, left = starts + sizes // 8 * 8, sizes % 8
    at = np.flatnonzero(short & (left >= 4))
    total[at] = _rotated(total[at] ^ _lanes(data, rest[at], 4) * _P1, 23) * _P2 + _P3
    rest, left = rest + left // 4 * 4, left % 4
    for k in range(3):
        at = np.flatnonzero(short & (left > k))
        total[at] = _rotated(total[at] ^ data[rest[at] + k].astype(np.uint64) * _P5, 11) * _P1
    total = (total ^ total >> np.uint64(33)) * _P2
    total = (total ^ total >> np.uint64(29)) * _P3
    total ^= total >> np.uint64(32)
    for i in np.flatnonzero(~short):
        total[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + sizes[i]].tobytes())
    return total


class Features:
    """An open-addressed table of the features of one piece of text. ``slots`` holds the slot of each occurrence; ``bucket`` and
    ``count`` are stored by slot."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, buckets: int):
        self.data, self.starts, self.sizes = data, starts, sizes
        width = 1 << max(4, int(2 * len(starts)).bit_length())
        keys = xxhash64(data, starts, sizes)
        owner = np.full(width, -1, np.int64)
        self.slots = (keys & np.uint64(width - 1)).astype(np.int64)
        waiting = np.arange(len(starts))
        while len(waiting):
            at = self.slots[waiting]
            free = owner[at] < 0
            owner[at[free]] = waiting[free]
            held = owner[at]
            same = keys[held] == keys[waiting]
            same[same] = self._same_bytes(held[same], waiting[same])
            waiting = waiting[~same]
            self.slots[waiting] = (self.slots[waiting] + 1) & (width - 1)
        self.count = np.bincount(self.slots, minlength=width)
        self.bucket = np.zeros(width, np.int32)
        used = np.flatnonzero(owner >= 0)
        first, raw = starts[owner[used]], data.tobytes()
        ends = first + sizes[owner[used]]
        sums = [zlib.crc32(raw[i:j]) for i, j in zip(first.tolist(), ends.tolist())]
        self.bucket[used] = np.array(sums, np.int64) % buckets

    def _same_bytes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Are the bytes of two features equal? Compared eight at a time."""
        same = self.sizes[a] == self.sizes[b]
        open_ = np.flatnonzero(same & (a != b))
        k = 0
        while len(open_):
            left = self.sizes[a[open_]] - k
            x, y = (_lanes(self.data, self.starts[f[open_]] + k, 8) for f in (a, b))
            beyond = np.uint64(8) * np.minimum(left, 8).astype(np.uint64)
            mask = np.where(left >= 8, ~np.uint64(0), (np.uint64(1) << (beyond & np.uint64(63))) - np.uint64(1))
            equal = (x ^ y) & mask == 0
            same[open_[~equal]] = False
            open_, k = open_[equal & (left > 8)], k + 8
        return same


def _features(run: words_of.Words, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of words in a piece that end in a word new to it: padded bytes, starts, sizes, and the text that owns each."""
    owner = np.repeat(np.arange(len(run.first) - 1), np.diff(run.first))
    sizes, new = run.ends - run.starts, np.arange(len(run.starts)) >= run.carried
    if longest == 1:
        return np.concatenate([run.data, np.zeros(_PAD, np.uint8)]), run.starts[new], sizes[new], owner[new]
    # Words one space apart, so that each run of them is one slice.
    places = np.cumsum(sizes + 1) - (sizes + 1)
    data = np.full(int((sizes + 1).sum()) + _PAD, 32, np.uint8)
    offsets = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    data[np.repeat(places, sizes) + offsets] = run.data[np.repeat(run.starts, sizes) + offsets]
    parts = []
    for n in range(1, min(longest, len(sizes)) + 1):
        first, last = np.arange(len(sizes) - n + 1), np.arange(n - 1, len(sizes))
        kept = (owner[first] == owner[last]) & new[last]
        first, last = first[kept], last[kept]
        parts.append((places[first], places[last] + sizes[last] - places[first], owner[first]))
    if not parts:
        return data, sizes, sizes, owner
    return data, *(np.concatenate(p) for p in zip(*parts))


def _pieces(column: pa.Array, longest: int) -> Iterator[tuple[words_of.Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for run in words_of.word_pieces(column, words_of.ALNUM, longest - 1, hashed=False):
        yield run, *_features(run, longest)


def bucket_counts(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """Features of all texts by bucket. A task sends one number per bucket; what comes back is as long as there are buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, starts, sizes, _ in _pieces(batch.column(0), longest):
                table = Features(data, starts, sizes, buckets)
                total += np.bincount(table.bucket, table.count, buckets).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    counted = docs.select(F.col(text).cast("string")).mapInArrow(count, "bucket INT, n BIGINT")
    total = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] = r["n"]
    return total


def gains_of(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of a bucket's smoothed share in the target to that in the documents, in thousandths."""
    s, t, n = own.astype(np.float64), target.astype(np.float64), len(own)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST, text: str = "text") -> DataFrame:
    """``docs`` without their text, with ``n_words``, ``n_features`` and ``weight``."""
    added = T.StructType([T.StructField(n, T.LongType()) for n in ADDED[:3]])
    docs = docs.drop(*ADDED[:3])
    rows, at = sheltered(docs), docs.columns.index(text)
    kept = [f for i, f in enumerate(rows.schema.fields) if i != at]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, sums = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for run, data, starts, sizes, owner in _pieces(batch.column(at), longest):
                table = Features(data, starts, sizes, len(gains))
                by_slot = gains[table.bucket]
                n = len(run.first) - 1
                part = slice(run.lo, run.lo + n)
                words[part] += np.diff(run.first)
                words[run.lo] -= run.carried
                features[part] += np.bincount(owner, minlength=n)
                # Sums of whole numbers far below 2**53 are exact.
                sums[part] += np.bincount(owner, by_slot[table.slots], n).astype(np.int64)
            weight = sums // np.maximum(features, 1)
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [f.name for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(words), pa.array(features), pa.array(weight)], names=[*names, *ADDED[:3]])

    weighed = rows.mapInArrow(score, T.StructType([*kept, *added.fields]))
    return weighed.select(*[F.col(place(docs, c)).alias(c) for c in docs.columns if c != text], *ADDED[:3])


def _noise(key: str, seed: int):
    known = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(known.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Draw ``percent`` of the documents of ``min_words`` words or more. All ``docs`` come back without their text, with
    ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``, which counts those drawn from 1 and is null for the others."""
    docs = docs.drop(*ADDED)
    gains = gains_of(bucket_counts(docs, longest, buckets, text), bucket_counts(target, longest, buckets, text))
    weighed = weigh(docs, gains, longest, text)
    scored = weighed.withColumn("score", F.col("weight") + _noise(key, seed))
    scored = staged(scored.toDF(*sheltered(scored).columns), "resample-scored")
    names = [*weighed.columns, "score"]
    at = {n: f"_kept_{i}" for i, n in enumerate(names)}
    long_enough = F.col(at["n_words"]) >= min_words

    by_score = scored.where(long_enough).groupBy(F.col(at["score"]).alias("s")).agg(F.count("*").alias("n"))
    by_score = staged(by_score, "resample-scores")
    wanted = (by_score.agg(F.sum("n")).first()[0] or 0) * percent // 100
    upto = F.sum("n").over(Window.orderBy(F.desc("s")))
    lowest = by_score.withColumn("upto", upto).where(F.col("upto") >= wanted).agg(F.max("s")).first()[0]

    drawn = long_enough & (F.col(at["score"]) >= F.lit(lowest)) if wanted else F.lit(False)
    order = [F.desc(at["score"]), F.asc_nulls_last(at[key]), F.asc(at["n_features"])]
    ranged = scored.where(drawn).repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    placed = staged(ranged.withColumn("_at", F.monotonically_increasing_id()), "resample-ranked")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = placed.join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = ranked.select(*scored.columns, F.when(rank <= wanted, rank).alias("rank"))
    rest = scored.where(~drawn).select("*", F.lit(None).cast("bigint").alias("rank"))
    both = ranked.unionByName(rest)
    return both.select(*[F.col(at[n]).alias(n) for n in names], "rank")
