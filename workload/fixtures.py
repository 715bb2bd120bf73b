"""Documents and patch logs built from the given tables by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = (
    "id BIGINT, at TIMESTAMP, kind STRING, amount DOUBLE, ratio FLOAT, big BOOLEAN, "
    "user STRUCT<id: INT, k: INT>, items ARRAY<STRUCT<p: INT, q: STRING>>, tags ARRAY<STRING>"
)

ENTITY_SCHEMA = (
    "profile STRUCT<name: STRING, segment: STRING, balance: DOUBLE>, scores ARRAY<INT>, active BOOLEAN"
)


#: Rows of a file that a stream reads.
ROWS_PER_FILE = 25_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deal_out(rows: DataFrame, path: str, least: int) -> int:
    """Add rows to a stream's source, in files of about ``ROWS_PER_FILE`` rows and ``least`` files or more, and return their
    number. Few tasks share a file, as many as it has row groups, so a fixed number of files would keep a stream to a few tasks."""
    files = max(least, -(-rows.count() // ROWS_PER_FILE))
    rows.repartition(files).write.mode("append").parquet(path)
    return files


def _field(name: str, text: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), text)


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def props_k() -> Column:
    return F.get_json_object("props", "$.k")


def event_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per event, ``(event_id, raw)``. The rest of
    ``event_id`` by 11 says which fault, if any, is put in: 0 text for
    ``user.k``, 1 no ``kind`` and a null ``amount``, 2 a time without a day for
    ``at``, 3 a ``user.id`` over 32 bits, 10 an extra field."""
    fault = F.col("event_id") % 11
    kind = _field("kind", _quoted(F.col("event_type")))
    k = props_k()
    item = lambda i: F.concat(F.lit(f'{{"p":{i},"q":"i'), F.lit(str(i)), F.lit('"}'))
    items = F.array_join(F.slice(F.array(item(1), item(2)), F.lit(1), (F.col("event_id") % 3).cast("int")), ",")
    fields = [
        _field("id", F.col("event_id").cast("string")),
        _field(
            "at",
            F.when(fault == 2, F.lit('"T10:00"')).otherwise(
                _quoted(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            ),
        ),
        F.when(fault != 1, kind),
        _field("amount", F.when(fault == 1, F.lit("null")).otherwise(F.col("value").cast("string"))),
        _field("ratio", (F.col("value") / 100).cast("float").cast("string")),
        _field("big", (F.col("value") > 50).cast("string")),
        F.concat(
            F.lit('"user":{"id":'),
            F.when(fault == 3, F.lit("3000000000")).otherwise(F.col("user_id").cast("string")),
            F.lit(',"k":'),
            F.when(fault == 0, _quoted(k)).otherwise(k),
            F.lit("}"),
        ),
        _field("items", F.concat(F.lit("["), items, F.lit("]"))),
        _field("tags", F.concat(F.lit('["'), F.col("event_type"), F.lit('"]'))),
        F.when(fault == 10, F.lit('"zz":true')),
    ]
    raw = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity per customer, as ``(c_custkey, profile, scores, active)``."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.struct(
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        ).alias("profile"),
        F.array(F.lit(1), F.lit(2), F.lit(3)).alias("scores"),
        F.lit(True).alias("active"),
    )


def patch_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One patch document per event, ``(c_custkey, seq, doc)``."""
    k = props_k()
    kind = F.col("event_type")
    path = (
        F.when(kind == "click", F.lit("/profile/segment"))
        .when(kind == "view", F.lit("/profile/balance"))
        .when(kind == "purchase", F.concat(F.lit("/scores/"), (k.cast("int") % 5).cast("string")))
        .when(kind == "signup", F.lit("/profile/nope"))
        .otherwise(F.lit("/active"))
    )
    value = (
        F.when(kind == "click", _quoted(k))
        .when(kind == "view", F.col("value").cast("string"))
        .when(kind == "purchase", k)
        .when(kind == "signup", k)
        .otherwise(F.lit('"yes"'))
    )
    doc = F.concat(F.lit('{"op":"replace","path":"'), path, F.lit('","value":'), value, F.lit("}"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("c_custkey"), F.col("event_id").alias("seq"), doc.alias("doc")
    )
