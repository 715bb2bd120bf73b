"""Tables on disk: files that do not fit, and loads that run again."""

import pytest
from pyspark.sql import functions as F

from tarn.operators.validate import parse_docs
from tarn.plans.schema import SchemaError
from tarn.sources.lake import read_lake, read_parquet_as, write_lake


@pytest.mark.parametrize("seed", range(6))
def test_every_mixed_folder_is_refused_by_the_file_name(spark, tmp_path, seed):
    path = str(tmp_path / "t")
    wide, narrow = spark.range(5).selectExpr("id", "id * 2 AS k"), spark.range(1).selectExpr("id")
    for i in range(4):
        (narrow if i == seed % 4 else wide).coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(SchemaError, match=r"1 files do not fit, such as .*\.parquet: /k is missing"):
        read_parquet_as(spark, path, "id BIGINT, k BIGINT")
    assert read_parquet_as(spark, path, "id BIGINT").count() == 16


@pytest.mark.parametrize("seed", range(6))
def test_every_mistyped_file_is_refused(spark, tmp_path, seed):
    path = str(tmp_path / "t")
    for i in range(3):
        kind = "STRING" if i == seed % 3 else "BIGINT"
        spark.range(2).selectExpr("id", f"named_struct('x', array(CAST(id AS {kind}))) AS s").coalesce(1).write.parquet(f"{path}/part={i}")
    with pytest.raises(SchemaError, match=f"such as .*part={seed % 3}/.*: /s/x/"):
        read_parquet_as(spark, path, "s STRUCT<x: ARRAY<BIGINT>>")
    # Narrower numbers fit, and so does a column from the folders' names.
    assert read_parquet_as(spark, path, "id BIGINT, part INT").agg(F.sum("part")).first()[0] == 6


def test_extra_columns_of_single_files_do_not_matter(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(3):
        spark.range(2).selectExpr("CAST(id AS INT) AS id", f"1 AS more{i}").coalesce(1).write.mode("append").parquet(path)
    spark.range(2).coalesce(1).write.mode("append").parquet(path)
    assert sorted(r["id"] for r in read_parquet_as(spark, path, "id BIGINT").collect()) == [0] * 4 + [1] * 4


def docs(spark, *raws):
    return parse_docs(spark.createDataFrame([(r,) for r in raws], "raw STRING"))


@pytest.mark.parametrize("aside", [False, True])
def test_a_load_run_again_adds_nothing(spark, tmp_path, aside):
    path, bad = str(tmp_path / "lake"), str(tmp_path / "bad") if aside else None

    def held():
        if aside:
            return sorted(r["a"] for r in spark.read.parquet(path).collect()), sorted(r["_raw"] for r in spark.read.parquet(bad).collect())
        return sorted(r["a"] for r in read_lake(spark, path).collect()), sorted(r["_raw"] for r in read_lake(spark, path, valid=False).collect())

    load = lambda batch, *raws: write_lake(docs(spark, *raws), "a INT", path, bad, batch=batch)
    load("2024-01-01", '{"a":1}', '{"a":"x"}')
    load("2024-01-02", '{"a":2}', '{"a":3}', "no")
    for _ in range(2):
        load("2024-01-02", '{"a":2}', '{"a":3}', "no")
        assert held() == ([1, 2, 3], ["no", '{"a":"x"}'])
    # A batch is replaced whole: what was bad in it and is mended now is not kept aside.
    load("2024-01-02", '{"a":2}', '{"a":4}')
    assert held() == ([1, 2, 4], ['{"a":"x"}'])
    with pytest.raises(ValueError):
        load("a/b", '{"a":1}')
