"""Layer schemas and the check that a frame has one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def struct(columns: str) -> T.StructType:
    """Schema of nullable columns from ``name type, name type``; needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


# Column names, types and order of trip files and of the three layers.
TRIP_FILE = struct(
    """
    vendor_id string, tpep_pickup_datetime string, tpep_dropoff_datetime string,
    passenger_count string, trip_distance string, rate_code_id string,
    store_and_fwd_flag string, pulocation_id string, dolocation_id string,
    payment_type string, fare_amount string, extra string, mta_tax string,
    tip_amount string, tolls_amount string, improvement_surcharge string,
    total_amount string, congestion_surcharge string
    """
)
LINEAGE = struct("_ingested_at string, _source_file string")
MONTH = struct("pickup_year int, pickup_month int")
BRONZE = T.StructType([*TRIP_FILE, *LINEAGE, *MONTH])
SILVER = struct(
    """
    vendor_id string, passenger_count int, trip_distance double, rate_code_id int,
    store_and_fwd_flag string, pulocation_id int, dolocation_id int,
    payment_type int, fare_amount double, extra double, mta_tax double,
    tip_amount double, tolls_amount double, improvement_surcharge double,
    total_amount double, congestion_surcharge double,
    _ingested_at timestamp, _source_file string,
    pickup_year int, pickup_month int,
    pickup_datetime timestamp, dropoff_datetime timestamp,
    trip_duration_minutes double, time_of_day string, is_weekend boolean,
    tip_percentage double
    """
)
def gold(count_type: str = "int") -> T.StructType:
    """Gold with trips counted as ``int``, as published, or ``bigint``."""
    return struct(
        f"""
        zone_id int, year int, month int, total_trips {count_type}, total_revenue double,
        avg_fare double, avg_tip double, revenue_per_mile double
        """
    )


GOLD = gold()

EXTRA = ("drop", "carry", "refuse")


def conform(df: DataFrame, schema: T.StructType, extra: str = "refuse") -> DataFrame:
    """Put the columns in schema order; stop when a name or type differs.

    Columns that the schema lacks are left out with ``extra="drop"`` and follow
    the others with ``"carry"``.
    """
    if extra not in EXTRA:
        raise ValueError(f"extra must be one of {EXTRA}, not {extra!r}")
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in schema.fields}
    more = [name for name in actual if name not in wanted]
    differing = {name for name in wanted if actual.get(name) != wanted[name]}
    if extra == "refuse":
        differing.update(more)
    if differing:
        raise TypeError(f"columns differ from the layer schema: {', '.join(sorted(differing))}")
    return df.select(*schema.names, *(more if extra == "carry" else ()))
