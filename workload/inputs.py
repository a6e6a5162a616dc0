"""The test tables seen as trips.

``events`` gives raw trip text and typed trips, ``lineitem`` gives typed rows
for metrics at size.  All rows of the tables take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlayer.plans.trips import RAW


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


_DROPOFF = "ts + make_dt_interval(0, 0, cast(event_id % 97 as int) - 5, 0)"

# Trip columns as text.  Some rows carry what raw files carry: words in place
# of numbers, blanks, integers with a fraction.
_TEXT = {
    "vendor_id": "event_type",
    "tpep_pickup_datetime": "cast(ts as string)",
    "tpep_dropoff_datetime": f"cast({_DROPOFF} as string)",
    "passenger_count": """
        case when event_id % 101 = 0 then 'n/a'
             when event_id % 3 = 0 then concat(cast(user_id % 7 as string), '.0')
             else cast(user_id % 7 as string) end""",
    "trip_distance": "cast(cast(value / 10 as decimal(18, 3)) as string)",
    "rate_code_id": "cast(event_id % 6 as string)",
    "store_and_fwd_flag": "if(event_id % 2 = 0, 'Y', 'N')",
    "pulocation_id": "cast(user_id % 25 as string)",
    "dolocation_id": "cast((user_id * 7) % 25 as string)",
    "payment_type": "cast(event_id % 5 as string)",
    "fare_amount": """
        case when event_id % 89 = 0 then null
             else cast(cast(value - 5.0 as decimal(18, 2)) as string) end""",
    "extra": "'0.5'",
    "mta_tax": "'0.5'",
    "tip_amount": "cast(cast(value * 0.15 as decimal(18, 4)) as string)",
    "tolls_amount": "'0.0'",
    "improvement_surcharge": "'0.3'",
    "total_amount": "cast(cast(value as decimal(18, 2)) as string)",
    "congestion_surcharge": "'0.0'",
}


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw trip text, in file column order."""
    columns = [F.expr(_TEXT[name]).cast("string").alias(name) for name in RAW.names]
    return events(spark, sf_dir).select(*columns)


def raw_trip_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Write the raw trips as CSV files; return a glob for them."""
    path = f"{folder}/trip_files"
    raw_trips(spark, sf_dir).write.option("header", True).csv(path)
    return f"{path}/*.csv"


# Line items as trip text; the date of one in 97 orders cannot be read.
_LINE_TEXT = _TEXT | {
    "vendor_id": "l_returnflag",
    "tpep_pickup_datetime": """
        if(l_orderkey % 97 = 0, concat('on ', l_shipdate), date_format(l_shipdate, 'yyyy-MM-dd'))""",
    "tpep_dropoff_datetime": "date_format(l_shipdate, 'yyyy-MM-dd')",
    "passenger_count": "cast(l_linenumber as string)",
    "trip_distance": "cast(l_quantity as string)",
    "rate_code_id": "'1'",
    "store_and_fwd_flag": "l_linestatus",
    "pulocation_id": "cast(l_suppkey as string)",
    "dolocation_id": "cast(l_partkey as string)",
    "payment_type": "'1'",
    "fare_amount": "cast(l_extendedprice as string)",
    "tip_amount": "cast(l_tax as string)",
    "total_amount": "cast(l_extendedprice as string)",
}


def line_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as raw trip text, in file column order."""
    columns = [F.expr(_LINE_TEXT[name]).cast("string").alias(name) for name in RAW.names]
    return lineitem(spark, sf_dir).select(*columns)


def native_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as typed trips, with the event id to tell rows apart."""
    return events(spark, sf_dir).select(
        "event_id",
        F.col("event_type").alias("vendor_id"),
        F.col("ts").cast("timestamp").alias("pickup_datetime"),
        F.expr(_DROPOFF).cast("timestamp").alias("dropoff_datetime"),
        F.expr("if(event_id % 101 = 0, null, cast(user_id % 7 as int))").alias("passenger_count"),
        F.expr("value / 10").alias("trip_distance"),
        F.expr("cast(user_id % 25 as int)").alias("pulocation_id"),
        F.expr("cast((user_id * 7) % 25 as int)").alias("dolocation_id"),
        F.expr("if(event_id % 89 = 0, null, value - 5.0)").alias("fare_amount"),
        F.expr("value * 0.15").alias("tip_amount"),
        F.col("value").alias("total_amount"),
    )


def silver_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under the silver names that the gold metrics read."""
    return lineitem(spark, sf_dir).select(
        F.col("l_suppkey").cast("int").alias("pulocation_id"),
        F.year("l_shipdate").alias("pickup_year"),
        F.month("l_shipdate").alias("pickup_month"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("tip_amount"),
        F.col("l_quantity").alias("trip_distance"),
    )
