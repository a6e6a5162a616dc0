"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def _nearest(links: DataFrame) -> DataFrame:
    """The least neighbour of every left end."""
    return links.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("least"))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(space: Workspace, links: DataFrame) -> DataFrame:
    """``a``, ``root`` for every number in the links ``a``, ``b`` that is not its component's least.

    Every round hangs each number's greater neighbours below its least neighbour,
    then its smaller ones; the links turn into stars in a number of rounds that
    grows with the logarithm of the longest chain.
    """
    links = space.keep(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    before = None
    while (now := _state(links)) != before:
        before = now
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _nearest(both).select("of", F.least("of", "least").alias("least"))
        large = both.join(least, F.col("a") == F.col("of")).where("b > a")
        large = space.keep(large.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())
        small = large.join(_nearest(large), F.col("a") == F.col("of"))
        turned = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        links = space.keep(turned.where("a <> b").distinct())
    return links.select("a", F.col("b").alias("root"))
