"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

    python bench.py            the headline queries, and one larger run on a busy entity
    python bench.py --large    and more single runs on larger made inputs

The tables are first dealt out to as many files as there are cores, as a lake would
hold them; that is not timed. Each query runs once to warm up and then three times;
the median counts. Results go to the no-op sink, so that all columns are computed
and nothing is stored.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

from tarn.operators import patches
from tarn.session import build_session
from workload import catalog

QUERIES = (
    "validate decode error_report shape_registry explode_nodes avro_layout sort_values compact_patch_log "
    "validate_patches apply_patch_log patch_rejects"
).split()

# The larger run that is always made: a busy entity.
HOT_RUN = "apply_patch_log, half of 2,000,000 patches on one entity"


def seconds(run):
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def dealt(spark, sf_dir, cpus):
    """The tables of the headline queries in ``cpus`` files each."""
    out = tempfile.mkdtemp(prefix="bench-")
    for name in ("events", "lineitem", "customer"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(cpus).write.parquet(f"{out}/{name}.parquet")
    return out


def _patches(spark, n, key, path, value="0"):
    return spark.range(n).select(
        key.cast("bigint").alias("k"), F.col("id").alias("seq"), F.lit("replace").alias("op"), path.alias("path"),
        F.try_parse_json(F.lit(value)).alias("value"),
    )


def large_runs(spark):
    """Name and run: a busy entity, long and nested arrays, a large table with a small log."""
    i = F.col("id")
    item = lambda n: F.concat(F.lit("/nums/"), (i % n).cast("string"))
    entities = lambda n, m: spark.range(n).select(i.alias("k"), F.sequence(F.lit(1), F.lit(m)).alias("nums"))
    schema = "nums ARRAY<INT>"
    busy = _patches(spark, 2_000_000, F.when(i % 2 == 0, F.lit(0)).otherwise(i % 1000), item(8))
    nested = spark.range(1).select(
        i.alias("k"), F.transform(F.sequence(F.lit(1), F.lit(200)), lambda _: F.sequence(F.lit(1), F.lit(80))).alias("nums")
    )
    deep = F.concat(F.lit("/nums/"), F.floor(i / 80).cast("string"), F.lit("/"), (i % 80).cast("string"))
    return {
        HOT_RUN: lambda: patches.apply_patch_log(
            entities(1000, 5), busy, schema, "k", "seq"
        ),
        "patch_rejects, the same log": lambda: patches.patch_rejects(entities(1000, 5), busy, schema, "k", "seq"),
        "apply_patch_log, 16,000 patches on 16,000 items of one array": lambda: patches.apply_patch_log(
            entities(1, 16_000), _patches(spark, 16_000, F.lit(0), item(16_000)), schema, "k", "seq"
        ),
        "apply_patch_log, 16,000 patches on 200 arrays of 80 in one": lambda: patches.apply_patch_log(
            nested, _patches(spark, 16_000, F.lit(0), deep), "nums ARRAY<ARRAY<INT>>", "k", "seq"
        ),
        "apply_patch_log, 100 patches on 2,000,000 entities": lambda: patches.apply_patch_log(
            entities(2_000_000, 20), _patches(spark, 100, i * 7, item(20)), schema, "k", "seq"
        ),
    }


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, rates, single = {}, {}, {}
    runs, tables = catalog.queries(), dealt(spark, sf_dir, int(cpus))
    for name in QUERIES:
        source = "lineitem" if name in ("avro_layout", "sort_values") else "events"
        rows = spark.read.parquet(f"{tables}/{source}.parquet").count()
        each = [seconds(lambda: runs[name](spark, tables)) for _ in range(4)]
        times[name] = round(statistics.median(each[1:]), 3)
        rates[name] = round(rows / times[name])
        print(name, times[name], file=sys.stderr)
    larger = large_runs(spark)
    for name, run in larger.items():
        if "--large" in sys.argv or name == HOT_RUN:
            single[name] = round(min(seconds(run) for _ in range(2)), 1)
            print(name, single[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total median seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_second": rates,
                "larger_runs": single,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
