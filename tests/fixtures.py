"""Raw trips of our own: a harbour ferry's evening, and one trip for each rule it can break."""

from pyspark.sql import functions as F

from siftlayer.operators import add_month_partitions
from siftlayer.plans.schemas import LINEAGE, MONTH, TRIP_FILE

COLUMNS = [*TRIP_FILE.names, *LINEAGE.names]
SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)
DAY = "2025-03-19"  # a Wednesday


def trip(vendor="ferry", start="18:40:00", end="19:25:30", **values):
    """A valid trip but for the values given; ``start`` and ``end`` are times of ``DAY``."""
    row = dict.fromkeys(COLUMNS, "0.25")
    row.update(
        vendor_id=vendor,
        tpep_pickup_datetime=f"{DAY} {start}",
        tpep_dropoff_datetime=f"{DAY} {end}",
        passenger_count="3",
        trip_distance="6.5",
        rate_code_id="4",
        store_and_fwd_flag="Y",
        pulocation_id="77",
        dolocation_id="31",
        payment_type="2",
        fare_amount="16.0",
        tip_amount="6.0",
        total_amount="26.0",
        _ingested_at="2025-03-20 04:30:00",
        _source_file="harbour.csv",
    )
    return row | values


VALID = trip()
NEGATIVE_FARE = trip("refund", fare_amount="-7.5", total_amount="-7.5")
NO_PASSENGERS = trip("empty", passenger_count="0")
ENDS_BEFORE_START = trip("backwards", end="18:39:59")


def bronze(spark, *rows):
    """Rows in memory as a source, under an explicit schema."""
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], SCHEMA)


def arrived(spark, *rows):
    """The same with the month columns of a bronze table."""
    pickup = F.to_timestamp("tpep_pickup_datetime")
    return add_month_partitions(bronze(spark, *rows), pickup, *MONTH.names)
