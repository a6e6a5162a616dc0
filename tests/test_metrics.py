"""Grouped metrics: null handling, guards, exact sums."""

import contextlib
import io
import math
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from siftlayer.operators import mean, ratio_of_totals, row_count, summarise, total
from workload import queries


def _one(spark, rows, *measures):
    """Apply measures, given as functions of the columns v and d, to all rows."""
    df = spark.createDataFrame(rows, "v double, d double")
    columns = (measure(F.col("v"), F.col("d")) for measure in measures)
    return tuple(summarise(df, {}, *columns).first())


@pytest.mark.parametrize("scale", [None, 2])
def test_nulls_are_skipped_but_counted_as_rows(spark, scale):
    rows = [(1.5, None), (None, None), (2.5, None)]
    measures = (
        lambda v, d: row_count("n"),
        lambda v, d: total(v, "s", scale),
        lambda v, d: mean(v, "m", scale),
        lambda v, d: total(d, "t", scale),
        lambda v, d: mean(d, "k", scale),
    )
    assert _one(spark, rows, *measures) == (3, 4.0, 2.0, None, None)


@pytest.mark.parametrize("scale", [None, 2])
@pytest.mark.parametrize(
    "rows, expected",
    [([(6.0, 2.0), (2.0, 2.0)], 2.0), ([(6.0, 0.0)], 0.0), ([(6.0, None)], 0.0),
     ([(6.0, -2.0)], 0.0), ([(None, 2.0)], None)],
)
def test_ratio_is_of_totals_and_guarded(spark, scale, rows, expected):
    assert _one(spark, rows, lambda v, d: ratio_of_totals(v, d, "r", scale)) == (expected,)


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 4)], "z int, v int")
    rows = summarise(df, {"zone": F.col("z")}, row_count("n")).collect()
    assert {(r["zone"], r["n"]) for r in rows} == {(None, 2), (3, 1)}


def test_fixed_point_sums_do_not_depend_on_order(spark):
    df = spark.range(100_000).select((F.col("id") % 1000 / 100).alias("v"))
    measures = (total(F.col("v"), "s", 2), mean(F.col("v"), "m", 2))
    results = {df.repartition(n).agg(*measures).first() for n in (1, 3, 7)}
    assert results == {(499_500.0, 4.995)}


@pytest.mark.parametrize("flag", [True, False])
@pytest.mark.parametrize("bad", [math.nan, math.inf, 1e18])
def test_fixed_point_refuses_what_it_cannot_hold(spark, ansi, flag, bad):
    ansi(flag)
    with pytest.raises(Exception, match="fixed-point"):
        _one(spark, [(bad, 1.0), (1.0, 1.0)], lambda v, d: total(v, "s", 2))


@pytest.mark.parametrize("scale, value", [(4, 0.00004), (2, 1.005), (0, 0.5), (2, 1e9 + 0.001)])
def test_fixed_point_refuses_more_decimals(spark, scale, value):
    with pytest.raises(Exception, match="fixed-point"):
        _one(spark, [(value, 1.0)], lambda v, d: total(v, "s", scale))


@pytest.mark.parametrize("value", [0.07, 1234567.8901, 9e9 + 0.0001, -0.0003, 0.0])
def test_fixed_point_takes_its_decimals(spark, value):
    assert _one(spark, [(value, 1.0)], lambda v, d: total(v, "s", 4)) == (value,)


@pytest.mark.parametrize("flag", [True, False])
def test_fixed_point_overflow_stops_the_job(spark, ansi, flag):
    ansi(flag)
    with pytest.raises(Exception, match="overflows"):
        _one(spark, [(9e16, 1.0)] * 2, lambda v, d: total(v, "s", 2))


def test_double_sums_carry_nan_and_what_is_too_large(spark):
    for values, expected in (
        ([math.nan, 1.0], math.nan), ([math.inf, 1.0], math.inf), ([math.inf, -math.inf], math.nan),
        ([1e300, 1.0], 1e300), ([1e30], 1e30), ([2.0**70, 2.0**69], 2.0**70 + 2.0**69), ([-0.0], 0.0),
    ):
        found = _one(spark, [(v, 1.0) for v in values], lambda v, d: total(v, "s"))[0]
        assert found == expected or math.isnan(found) and math.isnan(expected)


_DRAWS = {
    "money": lambda draw: round(draw.uniform(0, 100), 2),
    "both signs": lambda draw: draw.uniform(-1e3, 1e3),
    "cancelling": lambda draw: draw.choice([1e15, -1e15, 0.1, -0.3]),
    "all sizes": lambda draw: draw.choice([-1, 1]) * 2.0 ** draw.uniform(-19, 69),
    "tiny": lambda draw: draw.gauss(0, 1) * 1e-19,
}


@pytest.mark.parametrize("kind", _DRAWS)
@pytest.mark.parametrize("flag", [True, False])
def test_double_sums_are_exact_in_any_order(spark, ansi, kind, flag):
    """The sum is that of the exact numbers, rounded once; only bits below 2^-72 may go before."""
    ansi(flag)
    draw = random.Random(kind)
    values = [_DRAWS[kind](draw) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = {df.repartition(n).agg(total(F.col("v"), "s")).first()[0] for n in (1, 3, 8)}
    exact = sum(Fraction(round(Fraction(v) * 2**72)) for v in values) / 2**72
    assert found == {float(exact)}
    if kind != "tiny":
        assert found == {math.fsum(values)}


def test_the_cells_of_a_sum_do_not_nest(spark):
    """An expression that doubles with every cell would not be compiled any more."""
    df = spark.range(1).select(F.col("id").cast("double").alias("v"))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.agg(total(F.col("v"), "s")).explain()
    assert len(text.getvalue()) < 12_000


@pytest.mark.parametrize("flag", [True, False])
def test_int_count_never_wraps(spark, ansi, flag, monkeypatch):
    from siftlayer.operators import metrics

    ansi(flag)
    monkeypatch.setattr(metrics, "_MAX_INT", 1)
    with pytest.raises(Exception, match="n: group too large"):
        _one(spark, [(1.0, 1.0)] * 2, lambda v, d: row_count("n"))
    assert _one(spark, [(1.0, 1.0)] * 2, lambda v, d: row_count("n", "bigint")) == (2,)
    with pytest.raises(ValueError):
        row_count("n", "short")


def test_rows_dealt_anew_take_more_tasks_where_the_table_is_larger(spark, tmp_path, monkeypatch):
    lines = "1 AS l_suppkey, now() AS l_shipdate, 1D AS l_extendedprice, 0D AS l_discount, 2D AS l_quantity"
    spark.sql(f"SELECT {lines}").write.parquet(f"{tmp_path}/lineitem.parquet")
    widths = []
    for size in (10, 2**33):
        monkeypatch.setattr(queries, "scanned_bytes", lambda df, size=size: size)
        plan = queries.gold_metrics_default(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        widths.append(int(re.search(r"RepartitionByExpression \[.*\], (\d+)", plan)[1]))
    assert widths == [13, 1024]
