"""Helpers that several of the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import shared_folder

# What parts words, in Spark's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def default_tokenizer() -> str:
    """The vocabulary file that the packing queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Workspace:
    """Tables of one run, written below the folder that the cluster shares.

    A written table cuts the lineage: losing an executor afterwards repeats only
    what reads the table.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = shared_folder(spark)
        self._tables = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """The same rows, read from a table written now."""
        self._tables += 1
        path = f"{self.folder}/{self._tables}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns of a frame as one struct."""
    return F.struct(*[df[f"`{name.replace('`', '``')}`"] for name in df.columns]).alias("row")


def unit_hash(*columns: Column | str, seed: int) -> Column:
    """A number in (0, 1) that depends on the columns and the seed only."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**52))
