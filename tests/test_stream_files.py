"""The streams' sources are dealt out to files by their size, so that the tasks of a batch grow with it."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from workload import catalog, fixtures

ROWS, PER_FILE = 1050, 50


@pytest.fixture()
def sf_dir(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "ROWS_PER_FILE", PER_FILE, raising=False)
    monkeypatch.setattr(catalog, "work_dir", lambda _, name: str(tmp_path / name))
    n = F.col("id")
    events = spark.range(ROWS).select(
        n.alias("event_id"),
        F.timestamp_seconds(n).alias("ts"),
        (n % 20).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("click", "view", "purchase", "signup", "error"))), (n % 5 + 1).cast("int")).alias("event_type"),
        (n / 8).alias("value"),
        F.format_string('{"k":%d}', n % 7).alias("props"),
    )
    events.coalesce(1).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    customers = spark.range(20).select(
        F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit("s").alias("c_mktsegment"), F.lit(1.5).alias("c_acctbal")
    )
    customers.write.parquet(str(tmp_path / "sf" / "customer.parquet"))
    return str(tmp_path / "sf")


def source_files(tmp_path: Path, name: str) -> int:
    return len(list((tmp_path / name).glob("part-*.parquet")))


def batches(tmp_path: Path, name: str) -> int:
    return len([p for p in (tmp_path / name / "commits").iterdir() if p.name.isdigit()])


def test_ingest_source_grows_in_files(spark, tmp_path, sf_dir):
    rows = catalog.q_stream_ingest(spark, sf_dir).collect()
    assert source_files(tmp_path, "ingest-source") == ROWS // PER_FILE
    assert batches(tmp_path, "ingest-checkpoint") == 2
    assert sorted(r["event_id"] for r in rows) == list(range(ROWS))
    assert {r["event_id"] for r in rows if not r["ok"]} == {i for i in range(ROWS) if i % 11 < 4}


def test_patch_log_source_grows_in_files(spark, tmp_path, sf_dir):
    assert catalog.q_stream_patch_log(spark, sf_dir).count() == 20
    assert source_files(tmp_path, "patches-source") == ROWS // PER_FILE
    assert batches(tmp_path, "patches-checkpoint") == 2


def test_state_source_grows_in_files(spark, tmp_path, sf_dir):
    assert catalog.q_stream_latest_patches(spark, sf_dir).count() == 20
    half = -(-(ROWS // 2) // PER_FILE)
    assert source_files(tmp_path, "latest-source") == half + ROWS // PER_FILE
    assert batches(tmp_path, "latest-checkpoint") == 2


def test_small_sources_keep_their_least_number_of_files(spark, tmp_path):
    assert fixtures.deal_out(spark.range(10), str(tmp_path / "source"), least=4) == 4
    assert source_files(tmp_path, "source") == 4
