"""From raw documents to shards: filter by quality, drop near duplicates, decontaminate, mix and shard.

Each stage takes all rows its predecessor kept. ``run`` writes a stage as Parquet
in the shared work folder and reads it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarn.llm import decontaminate, mixing, near_dup, quality, sharding
from tarn.llm.queries import fold, table
from tarn.session import staged

#: Documents with so many of 100 five-word shingles in common are near duplicates.
NEAR_SIMILAR = 80
#: Part of all tokens that the mixture keeps.
MIX_SHARE = 0.5
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores under 0.5 go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1).select(*COLUMNS)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates stays."""
    return near_dup.keep_one(docs, similar=NEAR_SIMILAR).select(*COLUMNS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents so that tokens come to ``MIX_SHARE`` and near the target shares."""
    return mixing.mix(docs, share=MIX_SHARE).where("kept").select(*COLUMNS)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Name each document's shard."""
    return sharding.shard(docs).select(*COLUMNS, "shard", "depth", "shard_bytes")


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_dup_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing to target weights", mix_stage),
    ("sharding", shard_stage),
]

#: SQL cannot express the classifier and the mixture after it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
