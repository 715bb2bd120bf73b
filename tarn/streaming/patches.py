"""Entities kept up to date from a stream of patches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tarn.operators.patches import (
    REJECT_COLUMNS,
    apply_patch_log,
    content,
    judge_log,
    patch_rejects,
    read_patch_log,
    validate_patches,
)
from tarn.plans.columns import as_list, quoted, top
from tarn.session import claim, delete, measured, staged, staging


# Fixed value: a row for each version of the entities.
COMMIT = "version BIGINT, stream STRING, batch BIGINT"


def stream_patch_log(
    docs: DataFrame,
    schema: T.DataType | str,
    key: str | list[str],
    seq: str,
    out: str,
    checkpoint: str,
    doc: str = "doc",
    once: bool = False,
    **trigger,
) -> StreamingQuery:
    """Append a stream of patch documents to a table of judged patches, split by
    ``valid``. No state is kept: each patch is judged against the schema
    alone. ``current_entities`` reads the result."""
    judged = validate_patches(read_patch_log(docs, key, seq, doc), schema)
    rows = judged.withColumn("valid", F.col("code").isNull())
    writer = (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy("valid")
        .outputMode("append")
    )
    timing = {"availableNow": True} if once else trigger
    return (writer.trigger(**timing) if timing else writer).start()


def fold_patches(
    entities: DataFrame, patches: DataFrame, schema: T.DataType | str, key: str | list[str], seq: str, judged: bool = False
) -> tuple[DataFrame, DataFrame]:
    """One step: entities carrying ``last_seq`` and a batch of patches in, the
    next entities and the batch's rejects out. Patches not newer than
    ``last_seq``, replays and late arrivals, are never applied and are reported as
    ``stale_seq``.

    The patches are joined with the entities' marks only to report: a join by
    entity ahead of the aggregations would bring a busy entity to one task."""
    keys = as_list(key)
    checked = patches if judged else judge_log(patches, schema, keys, seq)
    after = apply_patch_log(entities, checked, schema, keys, seq, judged=True)
    marks = entities.select(*[top(k) for k in keys], F.col("last_seq").alias("_mark")).where("_mark IS NOT NULL")
    late = checked.join(marks, keys).where(top(seq) <= F.col("_mark")).withColumn("code", F.lit("stale_seq"))
    refused = patch_rejects(entities, checked, schema, keys, seq, judged=True).join(marks, keys, "left")
    refused = refused.where(F.col("_mark").isNull() | (top(seq) > F.col("_mark"))).drop("_mark")
    return after, refused.unionByName(late.select(*[top(k) for k in keys], top(seq), *REJECT_COLUMNS))


def latest_version(spark: SparkSession, out: str) -> int | None:
    """The last committed version of the entities. Only ``commits`` counts: a
    version folder without a commit is a write that failed."""
    try:
        commits = spark.read.schema(COMMIT).parquet(f"{out}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # nothing was committed yet
    return commits.agg(F.max("version")).first()[0]


def _version_of(spark: SparkSession, out: str, stream: str, batch_id: int) -> int | None:
    """The version that a stream's batch made, if it was committed."""
    commits = spark.read.schema(COMMIT).parquet(f"{out}/commits")
    own = commits.where((F.col("stream") == stream) & (F.col("batch") == batch_id))
    return own.agg(F.max("version")).first()[0]


# The table of entities is cut into so many parts at first, by the leading bits of the key's hash; a part of more
# bytes is split by further bits; and so many versions stay readable.
FIRST_BITS, MOST_BITS = 6, 32
BUCKET_BYTES = 128 << 20
KEPT_VERSIONS = 2

# Columns that the stored entities carry besides their own: where they lie, and the numbers that were in the entity from the
# start and were met since.
HIDDEN = ["_bucket", "_from", "_met"]


def _bits(keys: list[str]) -> Column:
    return F.lpad(F.bin(F.shiftrightunsigned(F.xxhash64(*[top(k) for k in keys]), 64 - MOST_BITS)), MOST_BITS, "0")


def _prefix(keys: list[str], bits: int | Column) -> Column:
    length = F.lit(bits) if isinstance(bits, int) else bits
    return F.concat(F.lit("b"), F.substring(_bits(keys), F.lit(1), length))


def _manifest(spark: SparkSession, out: str, version: int) -> DataFrame:
    """A row per bucket, its name the prefix of its hashes: the version that holds its rows."""
    return spark.read.schema("bucket STRING, of BIGINT").parquet(f"{out}/manifests/version={version}")


def _buckets(spark: SparkSession, out: str, found: list) -> DataFrame:
    paths = [f"{out}/entities/version={r['of']}/_bucket={r['bucket']}" for r in found]
    rows = spark.read.parquet(*paths)
    bucket = F.regexp_extract("_metadata.file_path", "_bucket=(b[01]*)", 1)
    return rows.select("*", bucket.alias("_bucket"))


def read_entities(spark: SparkSession, out: str, version: int | None = None) -> DataFrame:
    """The entities of the last committed version, or of an earlier one that is kept."""
    version = latest_version(spark, out) if version is None else version
    if version is None:
        raise ValueError(f"no committed version in {out}")
    return _buckets(spark, out, _manifest(spark, out, version).collect()).drop(*HIDDEN)


def _touched(manifest: DataFrame, patches: DataFrame, keys: list[str]) -> list:
    """The buckets that hold the keys of patches. Buckets differ in length, but none is the beginning of another."""
    lengths = [r[0] for r in manifest.select(F.length("bucket") - 1).distinct().collect()]
    asked = patches.select(F.explode(F.array(*[_prefix(keys, n) for n in lengths])).alias("bucket")).distinct()
    return manifest.join(asked, "bucket", "left_semi").collect()


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    """The bytes of each bucket of a version."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    return files.groupBy(F.regexp_extract("path", "_bucket=(b[01]*)", 1).alias("bucket")).agg(F.sum("length").alias("bytes"))


def _write_version(spark: SparkSession, out: str, entities: DataFrame, keys: list[str], version: int) -> None:
    """Write touched buckets, each as one file, then split those over ``BUCKET_BYTES`` until none is, or one key is left in it."""
    folder = f"{out}/entities/version={version}"
    entities.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(folder)
    tried: set[str] = set()
    while True:
        large = [
            r for r in _sizes(spark, folder).where(F.col("bytes") > BUCKET_BYTES).collect()
            if r["bucket"] not in tried and len(r["bucket"]) <= MOST_BITS
        ]
        if not large:
            return
        for r in large:
            own = spark.read.parquet(f"{folder}/_bucket={r['bucket']}")
            more = max(1, (-(-r["bytes"] // BUCKET_BYTES) - 1).bit_length())
            depth = min(MOST_BITS, len(r["bucket"]) - 1 + more)
            parts = own.withColumn("_bucket", _prefix(keys, depth))
            parts.repartition("_bucket").write.mode("append").partitionBy("_bucket").parquet(folder)
            delete(spark, f"{folder}/_bucket={r['bucket']}")
            tried |= {r["bucket"]}


def _list_version(spark: SparkSession, out: str, before: DataFrame | None, touched: list, version: int) -> None:
    """The manifest: buckets of this version, and those of the one before that were not touched."""
    made = _sizes(spark, f"{out}/entities/version={version}").select("bucket", F.lit(version).cast("bigint").alias("of"))
    if before is not None:
        gone = spark.createDataFrame([(r["bucket"],) for r in touched], "bucket STRING")
        made = made.unionByName(before.join(gone, "bucket", "left_anti"))
    made.write.mode("overwrite").parquet(f"{out}/manifests/version={version}")


def _drop_old(spark: SparkSession, out: str, version: int) -> None:
    """Delete buckets that only versions beyond the kept ones name."""
    old = version - KEPT_VERSIONS
    if old < -1:
        return
    gone = _manifest(spark, out, old).join(_manifest(spark, out, old + 1), ["bucket", "of"], "left_anti")
    for r in gone.toLocalIterator():
        delete(spark, f"{out}/entities/version={r['of']}/_bucket={r['bucket']}")


def start_entities(entities: DataFrame, out: str, key: str | list[str]) -> None:
    """Write the entities as they are before any patch, and from those the first version."""
    spark, keys = entities.sparkSession, as_list(key)
    if latest_version(spark, out) is not None:
        return
    first = entities if "last_seq" in entities.columns else entities.withColumn("last_seq", F.lit(None).cast("bigint"))
    first.write.mode("overwrite").parquet(f"{out}/base")
    rows = spark.read.parquet(f"{out}/base").select(
        "*", F.col("last_seq").alias("_from"), F.col("last_seq").alias("_met"), _prefix(keys, FIRST_BITS).alias("_bucket")
    )
    _write_version(spark, out, rows, keys, -1)
    _list_version(spark, out, None, [], -1)
    _commit(spark, out, -1, "", -1)


def _commit(spark: SparkSession, out: str, version: int, stream: str, batch_id: int) -> None:
    row = spark.range(1).select(
        F.lit(version).cast("bigint").alias("version"), F.lit(stream).alias("stream"), F.lit(batch_id).cast("bigint").alias("batch")
    )
    row.write.mode("append").parquet(f"{out}/commits")


def _ledger(spark: SparkSession, out: str, version: int) -> DataFrame | None:
    """All patches met up to a version."""
    try:
        return spark.read.parquet(f"{out}/ledger").where(F.col("version") <= version)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _met_before(
    before: DataFrame, judged: DataFrame, past: DataFrame | None, keys: list[str], seq: str
) -> tuple[DataFrame | None, DataFrame | None]:
    """Of a batch, the numbers that their entities met before, and the keys of entities whose patches do not simply follow
    those met: one comes late, or has the number of another that says something else. Either is None where there is none. The ledger is
    asked only about such numbers, which its files' ranges of numbers narrow down."""
    named = [quoted(k) for k in keys]
    least = judged.groupBy(*named).agg(F.min(top(seq)).alias("_least"))
    marks = before.select(*named, "_from", "_met").where("_met IS NOT NULL")
    returning, n = measured(least.join(marks, keys).where("_least <= _met").select(*named, "_from", "_met"), "returning")
    if not n or past is None:
        return None, None
    new = F.col("_from").isNull() | (top(seq) > F.col("_from"))
    old = judged.join(returning, keys).where((top(seq) <= F.col("_met")) & new)
    old, n = measured(old.select(*named, quoted(seq), content().alias("_content")), "old-numbers")
    if not n:
        return None, None
    lowest, highest = old.agg(F.min(top(seq)), F.max(top(seq))).first()
    known = past.where(top(seq).between(lowest, highest)).select(*named, quoted(seq), "_content")
    found = known.join(old, [*keys, seq, "_content"], "left_semi")
    odd, n = measured(old.join(found, [*keys, seq, "_content"], "left_anti").select(*named).distinct(), "disturbed")
    return old.select(*named, quoted(seq)), odd if n else None


def fold_batch(
    schema: T.DataType | str, key: str | list[str], seq: str, out: str, doc: str | None = "doc", stream: str = ""
) -> Callable[[DataFrame, int], None]:
    """The body of a micro-batch: fold it onto the buckets of entities that it touches,
    write those, a manifest and the rejects as the next version, commit last, then drop
    what no kept version names. Versions have a counter of
    their own; a commit names the stream (its checkpoint, say) and its batch. So a batch
    that is run again finds its commit and does nothing, or overwrites what it left, and
    a stream with a new checkpoint counts from 0 without losing anything.

    The entities are those that ``apply_patch_log`` makes of the whole log, however it is cut into batches and whatever
    comes late or again. A ledger keeps all patches met. Numbers that only go up are folded onto the entity; a copy of a patch in
    the ledger changes nothing; where a patch comes late, or unlike another of its number, that
    entity alone is made again from its start and the ledger (and all its refusals are reported again, as ``rebuilt``).

    Only one stream may write to ``out``: a version that another one has begun is refused (``claim``)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = latest_version(spark, out)
        if version is None:
            raise ValueError(f"call start_entities for {out} first")
        if _version_of(spark, out, stream, batch_id) is not None:
            return
        keys, now = as_list(key), version + 1
        if not claim(spark, f"{out}/claims/version={now}", f"{stream}#{batch_id}"):
            raise RuntimeError(f"another stream writes to {out}; if it is gone for good, delete {out}/claims/version={now}")
        with staging(spark):
            patches = staged(batch if doc is None else read_patch_log(batch, key, seq, doc), "batch")
            judged = judge_log(patches, schema, keys, seq)
            manifest = _manifest(spark, out, version)
            touched = _touched(manifest, patches, keys)
            before = _buckets(spark, out, touched or manifest.limit(1).collect())
            before = before if touched else before.limit(0)
            past = _ledger(spark, out, version)
            again, odd = _met_before(before, judged, past, keys, seq)
            plain = before if odd is None else before.join(odd, keys, "left_anti")
            # Numbers met before were refused then if they are past the last one applied, and stay so.
            done = plain.select(*[quoted(k) for k in keys], F.col("last_seq").alias("_done"))
            left_out = None if again is None else again.join(done, keys).where(F.col("_done").isNull() | (top(seq) > F.col("_done")))
            fresh = judged if again is None else judged.join(left_out.select(*[quoted(c) for c in (*keys, seq)]), [*keys, seq], "left_anti")
            after, rejects = fold_patches(plain, fresh, schema, keys, seq, judged=True)
            rejects = rejects.withColumn("rebuilt", F.lit(False))
            if odd is not None:
                base = spark.read.parquet(f"{out}/base").join(odd, keys, "left_semi")
                log = past.select(*patches.columns).unionByName(patches).join(odd, keys, "left_semi")
                made, refused = fold_patches(base, log, schema, keys, seq)
                made = made.join(before.select(*[quoted(k) for k in keys], *HIDDEN).join(odd, keys, "left_semi"), keys)
                after = after.unionByName(made)
                rejects = rejects.join(odd, keys, "left_anti").unionByName(refused.withColumn("rebuilt", F.lit(True)))
            met = judged.groupBy(*[quoted(k) for k in keys]).agg(F.max(top(seq)).alias("_newest"))
            after = after.join(met, keys, "left").withColumn("_met", F.greatest("_met", "_newest")).drop("_newest")
            _write_version(spark, out, after, keys, now)
            _list_version(spark, out, manifest, touched, now)
            numbered = judged.where(F.greatest(*[top(c).isNull() for c in (*keys, seq)]) == F.lit(False))
            numbered = numbered.select(*[top(c) for c in patches.columns], content().alias("_content"))
            numbered.write.mode("overwrite").parquet(f"{out}/ledger/version={now}")
            rejects.write.mode("overwrite").parquet(f"{out}/rejects/version={now}")
        _commit(spark, out, now, stream, batch_id)
        _drop_old(spark, out, now)

    return run


def stream_apply_patches(
    docs: DataFrame,
    entities: DataFrame,
    schema: T.DataType | str,
    key: str | list[str],
    seq: str,
    out: str,
    checkpoint: str,
    doc: str = "doc",
    **trigger,
) -> StreamingQuery:
    """Keep a versioned table of entities up to date from a stream of patch
    documents. State lives in tables, the entities and the ledger of patches met, and
    the last versions can be read while the stream runs. A batch rewrites the buckets
    that its keys fall in, which is all of them for a batch of many keys; where that
    is too much, use ``stream_patch_log`` and fold
    its table with ``fold_patches`` when a new version is due."""
    start_entities(entities, out, key)
    writer = docs.writeStream.foreachBatch(fold_batch(schema, key, seq, out, doc, checkpoint)).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def current_entities(
    entities: DataFrame, log_path: str, schema: T.DataType | str, key: str | list[str], seq: str
) -> DataFrame:
    """The entities with all patches of a ``stream_patch_log`` table applied."""
    log = entities.sparkSession.read.parquet(log_path).where(F.col("valid") == F.lit(True))
    return apply_patch_log(entities, log.select(*as_list(key), seq, "op", "path", "value", "raw"), schema, key, seq)
