"""The physical plans that make the operators hold at size."""

import contextlib
import io
import re

from siftlayer.plans import trips
from siftlayer.plans.schemas import BRONZE
from workload import inputs, queries


def _plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def _bronze(spark, tmp_path, sf_dir):
    path = str(tmp_path / "bronze")
    trips.to_bronze(inputs.raw_trips(spark, sf_dir)).write.parquet(path)
    return spark.read.schema(BRONZE).parquet(path)


def test_gold_reads_only_its_columns_and_shuffles_once(spark, sf_dir, tmp_path):
    path = str(tmp_path / "silver")
    trips.to_silver(trips.to_bronze(inputs.raw_trips(spark, sf_dir))).write.parquet(path)
    plan = _plan(trips.to_gold(spark.read.parquet(path)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    (columns,) = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert len(columns.split(",")) == 7


def test_silver_reduces_before_its_only_shuffle(spark, sf_dir, tmp_path):
    plan = _plan(trips.to_silver(_bronze(spark, tmp_path, sf_dir)))
    assert plan.count("Exchange") == 1
    below = plan[plan.index("Exchange"):]
    assert "partial_min" in below and "Filter" in below
    # derived columns are made after the shuffle
    assert "morning" not in below and "morning" in plan
    # no Python in the hot path
    assert "Python" not in plan and "Arrow" not in plan


def test_silver_does_not_read_the_partition_columns(spark, sf_dir, tmp_path):
    plan = _plan(trips.to_silver(_bronze(spark, tmp_path, sf_dir)))
    (columns,) = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert "pickup_year" not in columns


def test_rules_on_stored_columns_reach_the_scan(spark, sf_dir):
    plan = _plan(queries.valid_lines(spark, sf_dir))
    assert "GreaterThanOrEqual(l_quantity,0.0)" in plan


def test_bronze_is_map_only(spark, sf_dir):
    assert "Exchange" not in _plan(trips.to_bronze(inputs.raw_trips(spark, sf_dir)))


def test_counts_scan_once_and_hash_aggregate(spark, sf_dir, tmp_path):
    plan = _plan(trips.counts(_bronze(spark, tmp_path, sf_dir)))
    assert plan.count("FileScan") == 1 and "SortAggregate" not in plan


def test_typing_a_trip_compiles(spark, sf_dir, tmp_path):
    """The JVM leaves methods beyond 8000 bytes to its interpreter."""
    rows = _bronze(spark, tmp_path, sf_dir)
    text = io.StringIO()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(text):
            trips.to_silver(rows).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_sketches_meet_in_two_steps(spark, sf_dir):
    """No exchange carries one sketch of every task into a single partition."""
    from siftlayer.operators import layout

    plans = []
    frame = type(spark.range(0))
    first = frame.first
    try:
        frame.first = lambda self: (plans.append(_plan(self)), first(self))[1]
        bounds = layout.quantile_bounds(inputs.lineitem(spark, sf_dir), ["l_quantity"], 4)
    finally:
        frame.first = first
    (plan,) = plans
    assert len(bounds["l_quantity"]) == 15
    single = plan.index("SinglePartition")
    assert "Exchange hashpartitioning(_group" in plan[single:]
