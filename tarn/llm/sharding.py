"""Sharding by extendible hashing.

A document's shard is a prefix of its hash bits. A directory, indexed by prefix
bits, names the bucket of each prefix; only buckets over the byte limit split,
on one more bit, until every one fits. Splitting needs no rows, only the bytes
under each prefix, so the directory comes from aggregates: bytes are summed over
prefixes a few bits longer than an even split needs, rolled up to all shorter
prefixes, and a bucket is the first prefix on the way down that fits. Prefixes
that are still too large go on, alone, to the next bits.

Rows that share all hash bits (copies of one key beyond the limit) cannot be
split by bits: they are numbered in a written table and cut by running bytes
into pages ``+0``, ``+1``, ... of at most the limit.

Defined cases: a null or repeated ``doc_id`` is a key like any other; a null
text has 0 bytes; a document over the limit is alone in its shard or page, the only
shards over the limit; an empty table gives no row; further columns are kept, but
columns named ``shard``, ``depth`` or ``shard_bytes`` are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarn.llm.columns import place, restored, sheltered
from tarn.session import staged

#: Bits of the hash that may be used.
HASH_BITS = 60
#: Bits looked at beyond those that an even split would need.
SPARE_BITS = 4
#: Bytes of text in a shard of the registered queries.
SHARD_BYTES = 1 << 20

# Names of helper columns.
_HASH, _BYTES, _ROW, _PART = "_shard_hash", "_shard_bytes_of_row", "_shard_row", "_shard_part"


def key_hash(key: Column) -> Column:
    """The first 60 bits of the key's MD5 as a long."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def bits_text(prefix: Column, depth: Column) -> Column:
    """A prefix as its string of 0 and 1; the root is empty."""
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, "0"))


def directory(sizes: DataFrame, limit: int) -> DataFrame:
    """Buckets for rows of ``(hash, bytes)``: ``(depth, prefix, bytes, docs, full)``.

    ``full`` buckets hold rows of one hash and are over the limit. The loop runs
    once for most tables, and at most ``HASH_BITS / 5`` times."""
    spark = sizes.sparkSession
    by_hash = sizes
    found, top = None, 0
    while True:
        total = by_hash.agg(F.sum("bytes")).first()[0] or 0
        parts = 1 if top == 0 else by_hash.select(F.shiftright("hash", HASH_BITS - top)).distinct().count()
        share = total / max(parts, 1)
        depth = min(HASH_BITS, top + SPARE_BITS + max(1, math.ceil(math.log2(max(share / limit, 1)))))
        fine = by_hash.groupBy(F.shiftright("hash", HASH_BITS - depth).alias("fine")).agg(
            F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs")
        )
        levels = fine.select(
            F.explode(F.sequence(F.lit(top), F.lit(depth))).alias("depth"), "fine", "bytes", "docs"
        ).select("depth", F.expr(f"shiftright(fine, {depth} - depth)").alias("prefix"), "bytes", "docs")
        nodes = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
        large = nodes.where((F.col("bytes") > limit) & (F.col("docs") > 1)).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        # Below a large node lies either a bucket that fits or another large one.
        fits = nodes.where((F.col("bytes") <= limit) | (F.col("docs") == 1)).withColumn(
            "parent", F.shiftright("prefix", 1)
        )
        buckets = fits.join(large, ["depth", "parent"], "left_semi").drop("parent")
        if top == 0:
            buckets = buckets.unionByName(fits.where("depth = 0").drop("parent"))
        found = buckets if found is None else found.unionByName(buckets)
        found = staged(found, "shard-buckets")
        rest = nodes.where((F.col("depth") == depth) & (F.col("bytes") > limit) & (F.col("docs") > 1))
        if depth == HASH_BITS:
            return found.withColumn("full", F.lit(False)).unionByName(rest.withColumn("full", F.lit(True)))
        rest = staged(rest.select("prefix"), "shard-rest")
        if rest.isEmpty():
            return found.withColumn("full", F.lit(False))
        by_hash = by_hash.join(
            rest.withColumnRenamed("prefix", "_p"), F.shiftright("hash", HASH_BITS - depth) == F.col("_p"), "left_semi"
        )
        top = depth


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Number the rows of each full hash by running bytes, without gathering a
    hash in one task: the rows are written, and sums by file part come first.

    A row over half the limit gets a page of its own; the others start a page
    for each half limit, so that no page of several rows passes the limit."""
    rows = staged(
        rows.withColumn(_ROW, F.monotonically_increasing_id()).withColumn(_PART, F.shiftright(_ROW, 33)), "shard-full"
    )
    half = max(1, limit // 2)
    alone = F.col(_BYTES) > half
    small = F.when(alone, F.lit(0)).otherwise(F.col(_BYTES))
    sums = rows.groupBy(_HASH, _PART).agg(F.sum(small).alias("_sum"))
    earlier = Window.partitionBy(_HASH).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(_HASH, _PART, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(_HASH, _PART).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, -1)
    page = F.when(alone, F.concat(F.lit("+row"), F.col(_ROW).cast("string"))).otherwise(
        F.concat(F.lit("+"), F.floor((F.col("_running") + F.col("_before")) / half).cast("string"))
    )
    rows = rows.withColumn("_running", F.coalesce(F.sum(small).over(inside), F.lit(0)))
    paged = rows.join(sums, [_HASH, _PART]).withColumn("shard", F.concat("shard", page))
    sums = paged.groupBy("shard").agg(F.sum(_BYTES).alias("_page_bytes"))
    paged = paged.drop("shard_bytes").join(sums, "shard").withColumnRenamed("_page_bytes", "shard_bytes")
    return paged.drop("_before", "_running", _PART, _ROW)


def shard(docs: DataFrame, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``shard`` (its bits, and a page where it has one), ``depth``
    and ``shard_bytes``. Only (hash, bytes) sums are shuffled for the directory;
    the rows meet it in a join that Spark broadcasts when it is small."""
    docs = docs.drop("shard", "depth", "shard_bytes")
    size = F.coalesce(F.octet_length(place(docs, text)), F.lit(0)).cast("bigint")
    rows = sheltered(docs).withColumn(_HASH, key_hash(F.col(place(docs, key)))).withColumn(_BYTES, size)
    sizes = staged(
        rows.groupBy(F.col(_HASH).alias("hash")).agg(F.sum(_BYTES).alias("bytes"), F.count("*").alias("docs")), "shard-sizes"
    )
    found = staged(directory(sizes, limit), "shard-directory")
    deepest = found.agg(F.max("depth")).first()[0] or 0
    # The directory proper: each used prefix of the deepest length names its bucket.
    entries = sizes.select(F.shiftright("hash", HASH_BITS - deepest).alias("entry")).distinct()
    depths = F.array(*[F.lit(d) for d in range(deepest + 1)])
    pointers = entries.select("entry", F.explode(depths).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(entry, {deepest} - depth)")
    )
    pointers = pointers.join(found, ["depth", "prefix"]).select(
        F.col("entry").alias("_entry"),
        bits_text(F.col("prefix"), F.col("depth")).alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        F.col("bytes").alias("shard_bytes"),
        F.col("full").alias("_full"),
    )
    rows = rows.withColumn("_entry", F.shiftright(_HASH, HASH_BITS - deepest))
    placed = rows.join(pointers, "_entry").drop("_entry")
    whole = restored(placed.where(~F.col("_full")), docs, "shard", "depth", "shard_bytes")
    if not found.where("full").take(1):
        return whole
    paged = _pages(placed.where("_full").drop("_full"), limit)
    return whole.union(restored(paged, docs, "shard", "depth", "shard_bytes"))
