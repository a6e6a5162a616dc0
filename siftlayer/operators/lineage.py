"""Lineage and partition columns for rows as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"


def add_lineage(df: DataFrame) -> DataFrame:
    """Add when (text, one value per query) and from which file a row came.

    Call it right on the scan: the file name is only known while a file is
    being read and is empty for rows that come from elsewhere.
    """
    return df.withColumns(
        {
            INGESTED_AT: F.current_timestamp().cast("string"),
            SOURCE_FILE: F.input_file_name(),
        }
    )


def add_month_partitions(df: DataFrame, moment: Column, year: str, month: str) -> DataFrame:
    """Add integer year and month columns to partition a table by.

    Rows without a readable moment get null in both and end up in the null
    partition instead of being lost.
    """
    return df.withColumns({year: F.year(moment), month: F.month(moment)})
