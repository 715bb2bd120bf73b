"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm import (
    chat_format,
    conversation_repair,
    decontaminate,
    language,
    language_model,
    line_dedup,
    mixing,
    near_dup,
    nearest,
    quality,
    resample,
    secret_scan,
    sharding,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    both = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        both.alias("text"),
    )
    return chat_format.read_back(chat_format.format_chat(turns.unionByName(probe)))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_documents(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return sharding.shard(docs).select("doc_id", size.alias("n_bytes"), "shard", "depth", "shard_bytes")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.dedup_lines(docs)
    return found.select("doc_id", "n_lines", "n_deleted", "n_runs", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = language.learn(docs, fold("doc_id", 5) != 0)
    found = language.identify(docs.select("doc_id", "text"), net)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(docs).select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("p", 6).alias("p"), "kept"
    )


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return language_model.score_documents(docs, fold("doc_id", 5) == 1)


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample.resample(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a repository, and its source the owner."""
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "owned")
    return found.select(
        "doc_id", *[count(k) for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.listed(base).cast("binary"), 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"),
        F.col("n_live").cast("bigint").alias("n_live"), F.col("n_example").cast("bigint").alias("n_example"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with a fault in some, chosen by crc32 of ``conv_id:turn``, modulo 20; nulls are one space."""
    known = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    pick = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), pick.alias("pick"))
    text = F.when(F.col("pick") == 1, "").when(F.col("pick") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("pick") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("pick") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = rows.where("pick <> 0")
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.report(damaged(turns), turns)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
