"""The trip preset: taxi trip records as bronze, silver and gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlayer.functions import day_part, elapsed_minutes, guarded_percentage, is_weekend
from siftlayer.functions.casting import parse_text
from siftlayer.operators import (
    Field,
    add_lineage,
    add_month_partitions,
    apply_types,
    deduplicate,
    keep_valid,
    mean,
    ratio_of_totals,
    row_count,
    summarise,
    total,
)
from siftlayer.operators.lineage import INGESTED_AT, SOURCE_FILE
from siftlayer.operators.validity import all_of, non_negative, not_before, positive
from siftlayer.plans.schemas import BRONZE, LINEAGE, MONTH, SILVER, TRIP_FILE, conform, gold

# The text columns of a trip file, in file order.
RAW = TRIP_FILE
PARTITIONS = tuple(MONTH.names)

# What silver is made of: bronze without the columns it is partitioned by.
ARRIVED = T.StructType([*TRIP_FILE, *LINEAGE])

# Silver columns that have another name in the files.
RENAMED = {
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
}


def _fields() -> list[Field]:
    """Every silver column that bronze holds as text under the same or another name."""
    text = {f.name for f in BRONZE if isinstance(f.dataType, T.StringType)}
    return [
        Field(f.name, f.dataType.simpleString(), RENAMED.get(f.name))
        for f in SILVER
        if not isinstance(f.dataType, T.StringType) and RENAMED.get(f.name, f.name) in text
    ]


FIELDS = tuple(_fields())

# Two records with the same values here are the same trip.
TRIP_KEY = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pulocation_id",
    "dolocation_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
)

GOLD_ORDER = ("zone_id", "year", "month")


def to_bronze(raw: DataFrame, on_error: str = "null") -> DataFrame:
    """Text as received, plus lineage and partition columns."""
    pickup = parse_text(
        F.col("tpep_pickup_datetime"), "timestamp", on_error, "tpep_pickup_datetime"
    )
    return add_month_partitions(add_lineage(raw), pickup, *PARTITIONS)


def typed(bronze: DataFrame, on_error: str = "null") -> DataFrame:
    """Bronze text with silver types and names."""
    return add_month_partitions(
        apply_types(bronze, FIELDS, on_error), F.col("pickup_datetime"), *PARTITIONS
    )


def trip_rules() -> list[Column]:
    """A trip has a fare, passengers, and an end that is not before its start."""
    return [
        non_negative("fare_amount"),
        positive("passenger_count"),
        not_before("dropoff_datetime", "pickup_datetime"),
    ]


def valid(trips: DataFrame) -> DataFrame:
    """Trips that satisfy all of :func:`trip_rules`."""
    return keep_valid(trips, trip_rules())


def derived(trips: DataFrame) -> DataFrame:
    """Duration, part of day, weekend flag and tip share."""
    pickup = F.col("pickup_datetime")
    return trips.withColumns(
        {
            "trip_duration_minutes": elapsed_minutes(pickup, F.col("dropoff_datetime")),
            "time_of_day": day_part(pickup),
            "is_weekend": is_weekend(pickup),
            "tip_percentage": guarded_percentage(F.col("tip_amount"), F.col("fare_amount")),
        }
    )


def unique(trips: DataFrame, keep: str = "first") -> DataFrame:
    """One record per trip; of several copies the one ingested first."""
    return deduplicate(trips, TRIP_KEY, keep, order_by=(INGESTED_AT, SOURCE_FILE))


def to_silver(
    bronze: DataFrame, on_error: str = "null", keep: str = "first", extra: str = "drop"
) -> DataFrame:
    """Typed, valid, unique and derived trips.

    Year, month and the derived columns depend only on the row, so they are
    computed after the shuffle of the dedup and do not travel through it.
    Columns that later files brought are dropped, or carried to the end with
    ``extra="carry"``.
    """
    known = conform(bronze.drop(*PARTITIONS), ARRIVED, extra)
    rows = unique(valid(apply_types(known, FIELDS, on_error)), keep)
    calendar = add_month_partitions(rows, F.col("pickup_datetime"), *PARTITIONS)
    return conform(derived(calendar), SILVER, extra)


def counts(bronze: DataFrame, on_error: str = "null") -> DataFrame:
    """One row: trips received, valid, and valid and unique, in one pass."""
    flagged = apply_types(bronze, FIELDS, on_error).withColumn(
        "ok", F.coalesce(all_of(trip_rules()), F.lit(False))
    )
    # Rejected rows share one group, which every task boils down to one row.
    per_trip = summarise(
        flagged,
        {"ok": F.col("ok"), **{k: F.when(F.col("ok"), F.col(k)) for k in TRIP_KEY}},
        row_count("rows", "bigint"),
    )
    return per_trip.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("rows"))), F.lit(0)).alias("rows_valid"),
        F.count_if(F.col("ok")).alias("rows_unique"),
    )


def to_gold(
    silver: DataFrame, scale: int | None = None, count_type: str = "int"
) -> DataFrame:
    """Trips, revenue, average fare and tip, revenue per mile by zone and month.

    ``count_type="bigint"`` is for groups beyond 2^31 - 1 trips.
    """
    metrics = summarise(
        silver,
        {
            "zone_id": F.col("pulocation_id"),
            "year": F.col("pickup_year"),
            "month": F.col("pickup_month"),
        },
        row_count("total_trips", count_type),
        total(F.col("total_amount"), "total_revenue", scale),
        mean(F.col("fare_amount"), "avg_fare", scale),
        mean(F.col("tip_amount"), "avg_tip", scale),
        ratio_of_totals(
            F.col("total_amount"), F.col("trip_distance"), "revenue_per_mile", scale
        ),
    )
    return conform(metrics, gold(count_type))
