"""Time the work on rows rather than planning: the test tables enlarged once.

``python bench_rows.py [TIMES]`` writes bronze trips made of TIMES shifted copies
of the events and line items, each delivered twice, and prints one JSON line: the silver job
beside a plain pipeline (a cast for each column, ``dropDuplicates``, and counts
by jobs of their own), the two ways of grouping in the dedup, and the parsing of
doubles beside a plain cast.  ``BENCH_SF_DIR`` and ``BENCH_CPUS`` are those of ``bench.py``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bench import _session
from siftlayer.functions.casting import parse_text
from siftlayer.operators import deduplicate
from siftlayer.plans import jobs, trips
from siftlayer.sinks import append_partitioned
from siftlayer.sources import read_table
from siftlayer.workspace import shared_folder
from workload import inputs


def _seconds(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 2)


def _drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _bronze(spark: SparkSession, sf_dir: str, layers: jobs.Layers, times: int) -> None:
    raw = inputs.raw_trips(spark, sf_dir).unionByName(inputs.line_trips(spark, sf_dir))
    copies = F.explode(F.sequence(F.lit(1), F.lit(times))).alias("copy")
    many = raw.select("*", copies).withColumn("vendor_id", F.concat("vendor_id", F.col("copy")))
    rows = trips.to_bronze(many.drop("copy").repartition(32))
    for _ in range(2):
        append_partitioned(rows, layers.bronze, trips.PARTITIONS, layers.location("bronze"), True)


def _plain(bronze: DataFrame, path: str) -> None:
    """What a chain of casts would do, with a job for every count."""
    silver = bronze
    for field in trips.FIELDS:
        silver = silver.withColumn(field.name, F.col(field.origin).try_cast(field.type))
    silver = trips.derived(trips.valid(silver)).dropDuplicates(list(trips.TRIP_KEY))
    bronze.count()
    silver.count()
    silver.write.parquet(path)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    times = int(sys.argv[1]) if len(sys.argv) > 1 else 5
    spark = _session(os.environ.get("BENCH_CPUS", "8"))
    name = f"rows_{int(time.time())}"
    layers = jobs.Layers(f"b_{name}", f"s_{name}", f"g_{name}", shared_folder(spark))
    _bronze(spark, sf_dir, layers, times)
    bronze = read_table(spark, layers.bronze)
    typed = trips.valid(trips.typed(bronze)).select(*trips.TRIP_KEY, "tip_amount", "_source_file")
    out = {
        "bronze_rows": bronze.count(),
        "silver_job": _seconds(lambda: jobs.refine(spark, layers)),
        "plain_pipeline": _seconds(lambda: _plain(bronze, f"{layers.folder}/plain")),
        "dedup_first": _seconds(lambda: _drain(deduplicate(typed, trips.TRIP_KEY))),
        "dedup_dropDuplicates": _seconds(lambda: _drain(typed.dropDuplicates(list(trips.TRIP_KEY)))),
    }
    doubles = [f.name for f in trips.FIELDS if f.type == "double"]
    for label, parse in (
        ("doubles_parsed", lambda c: parse_text(F.col(c), "double")),
        ("doubles_cast", lambda c: F.col(c).try_cast("double")),
    ):
        out[label] = _seconds(lambda parse=parse: _drain(bronze.select(*map(parse, doubles))))
    out["silver_rows"] = read_table(spark, layers.silver).count()
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
