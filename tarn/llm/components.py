"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.session import staged


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``edges (a, b)``; ``comp`` is the
    smallest node of its component.

    Stars are alternated: each node hands its larger neighbours, then its smaller
    ones, to its smallest neighbour. Edges never grow in number, each round is
    written, and only counts and checksums reach the driver."""
    either = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = staged(either, "component-edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
            )
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Edges point down now, so u's smaller neighbours are its targets.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u")
        moved = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "component-edges")
