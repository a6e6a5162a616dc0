"""The trip steps on hand-written rows, and the rules at their edges."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from siftlayer.functions import day_part, elapsed_minutes, guarded_percentage, is_weekend
from siftlayer.operators import Field, apply_types, deduplicate, keep_valid
from siftlayer.operators.validity import non_negative
from siftlayer.plans import trips
from siftlayer.plans.schemas import GOLD, SILVER, conform
from tests.fixtures import (
    ENDS_BEFORE_START,
    NEGATIVE_FARE,
    NO_PASSENGERS,
    VALID,
    arrived,
    bronze,
    trip,
)


def test_only_the_valid_row_is_kept(spark):
    rows = bronze(spark, VALID, NEGATIVE_FARE, NO_PASSENGERS, ENDS_BEFORE_START)
    kept = trips.valid(trips.typed(rows)).collect()
    assert [r["vendor_id"] for r in kept] == ["ferry"]


def test_rules_at_their_edges(spark):
    rows = bronze(
        spark,
        trip("zero fare", fare_amount="0"),
        trip("no time", end="18:40:00"),
        trip("nan fare", fare_amount="NaN"),
        trip("decimal passengers", passenger_count="1.0"),
        trip("null fare", fare_amount=None),
        trip("text fare", fare_amount="free"),
        trip("blank passengers", passenger_count=""),
        trip("null end", tpep_dropoff_datetime=None),
        trip("bad start", tpep_pickup_datetime="soon"),
    )
    kept = {r["vendor_id"] for r in trips.valid(trips.typed(rows)).collect()}
    assert kept == {"zero fare", "no time", "nan fare", "decimal passengers"}


def test_derived_columns(spark):
    row = trips.derived(trips.typed(bronze(spark, VALID))).first()
    assert row["trip_duration_minutes"] == 45.5
    assert row["time_of_day"] == "evening"
    assert row["is_weekend"] is False
    assert row["tip_percentage"] == pytest.approx(37.5)


@pytest.mark.parametrize(
    "hour, part",
    [(0, "night"), (4, "night"), (5, "morning"), (11, "morning"), (12, "afternoon"),
     (16, "afternoon"), (17, "evening"), (20, "evening"), (21, "night"), (23, "night")],
)
def test_day_parts(spark, hour, part):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6, hour, 59, 59),)], "t timestamp_ntz")
    assert df.select(day_part(F.col("t"))).first()[0] == part


def test_calendar_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "t timestamp")
    assert tuple(df.select(day_part(F.col("t")), is_weekend(F.col("t"))).first()) == (
        "night",
        None,
    )


def test_weekend_days(spark):
    days = [(dt.datetime(2024, 1, d),) for d in range(1, 8)]  # Monday to Sunday
    df = spark.createDataFrame(days, "t timestamp_ntz").orderBy("t")
    flags = [r[0] for r in df.select(is_weekend(F.col("t"))).collect()]
    assert flags == [False] * 5 + [True] * 2


def test_duration_uses_whole_seconds(spark):
    text = [
        ("2024-01-01 00:00:00.9", "2024-01-01 00:01:00.1"),
        ("1969-12-31 23:59:59.5", "1970-01-01 00:00:00"),
    ]
    df = spark.createDataFrame(text, "a string, b string").select(
        F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b")
    )
    minutes = [r[0] for r in df.select(elapsed_minutes(F.col("a"), F.col("b"))).collect()]
    assert minutes == [1.0, 1 / 60.0]


def test_percentage_guard(spark):
    rows = [(2.0, 10.0), (2.0, 0.0), (2.0, -1.0), (2.0, None), (None, 10.0)]
    df = spark.createDataFrame(rows, "tip double, fare double")
    shares = [r[0] for r in df.select(guarded_percentage(F.col("tip"), F.col("fare"))).collect()]
    assert shares == [20.0, 0.0, 0.0, 0.0, None]


def test_same_trip_twice_is_one(spark):
    copy = dict(VALID, _ingested_at="2025-03-21 00:00:00", _source_file="later.csv")
    for keep in ("first", "any"):
        silver = trips.to_silver(arrived(spark, copy, VALID, copy), keep=keep)
        assert silver.count() == 1
    assert trips.to_silver(arrived(spark, copy, VALID)).first()["_source_file"] == "harbour.csv"


def test_silver_has_its_schema_and_order(spark):
    silver = trips.to_silver(arrived(spark, VALID))
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in SILVER
    ]
    assert len(SILVER) == 26 and len(GOLD) == 8 and len(trips.RAW) == 18


def test_conform_names_the_columns_that_differ(spark):
    df = spark.createDataFrame([(1, 2)], "zone_id int, yeer int")
    with pytest.raises(TypeError, match="avg_fare.*yeer"):
        conform(df, GOLD)


def test_derive_after_dedup_equals_derive_before(spark, sf_dir):
    from workload import inputs

    rows = trips.to_bronze(inputs.raw_trips(spark, sf_dir))
    stepwise = conform(trips.unique(trips.derived(trips.valid(trips.typed(rows)))), SILVER)
    direct = trips.to_silver(rows)
    hidden = ("_ingested_at", "_source_file")
    assert stepwise.drop(*hidden).exceptAll(direct.drop(*hidden)).isEmpty()
    assert stepwise.count() == direct.count()


def test_typing_keeps_positions_and_moves_renamed_columns_last(spark):
    df = spark.createDataFrame([("a", "1", "2", "3")], "x string, n string, old string, y string")
    typed = apply_types(df, [Field("new", "int", "old"), Field("n", "double")])
    assert typed.dtypes == [("x", "string"), ("n", "double"), ("y", "string"), ("new", "int")]


def test_null_rule_drops_the_row(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,), (math.nan,)], "v double")
    assert keep_valid(df, [non_negative("v")]).count() == 2


def test_dedup_keys(spark):
    rows = [(None, 0.0, "b"), (None, -0.0, "a"), (1, math.nan, "c"), (1, math.nan, None)]
    df = spark.createDataFrame(rows, "k int, d double, p string")
    for keep in ("first", "any"):
        assert deduplicate(df, ["k", "d", "absent"], keep).count() == 2
    assert {r["p"] for r in deduplicate(df, ["k", "d"]).collect()} == {"a", None}
    assert deduplicate(df.select("k"), ["k"]).count() == 2
    with pytest.raises(ValueError, match="none of the keys"):
        deduplicate(df, ["absent"])
    with pytest.raises(ValueError, match="keep"):
        deduplicate(df, ["k"], "last")


def test_dedup_of_a_hot_key_against_brute_force(spark):
    rows = [(i % 2 and i % 7, str(i * 37 % 101), float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, p string, v double").repartition(8)
    expected = {}
    for k, p, v in rows:
        expected[k] = min(expected.get(k, (v, p)), (v, p))
    found = {r["k"]: (r["v"], r["p"]) for r in deduplicate(df, ["k"], order_by=["v"]).collect()}
    assert found == expected


def test_counts(spark):
    rows = bronze(spark, VALID, VALID, NEGATIVE_FARE, trip(fare_amount=None), trip("V9"))
    assert tuple(trips.counts(rows).first()) == (5, 3, 2)
    assert tuple(trips.counts(rows.limit(0)).first()) == (0, 0, 0)
