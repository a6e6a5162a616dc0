"""Shards of near equal bytes by a histogram sort.

The rows are ordered by the CRC-32 of their text, then by ``doc_id``.  Each
round counts the exact bytes that lie below a set of candidate boundaries and
keeps, for every shard boundary still open, the one interval between two
candidates that holds it.  A boundary is settled as soon as a candidate is near
enough to the wanted share; inside a group of equal texts the search goes on
over ``doc_id``, so a group of any size is cut where it must be.  Then the rows
move once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, whole_row

PROBES = 256
TOLERANCE = 1e-4
_LEAST = -(2**63)
_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


#: What rows are ordered by; the last is different for each row.
KEYS = ("crc", "tie", "number")


@dataclass
class _Boundary:
    """The search for one splitter: ``below`` bytes lie under ``low``."""

    wanted: float
    low: int
    high: int
    below: int = 0
    fixed: tuple[int, ...] = ()  # the values of the first keys, once the search is within one group
    found: tuple[int, ...] | None = None

    @property
    def interval(self) -> tuple[tuple[int, ...], int, int]:
        return self.fixed, self.low, self.high

    def key(self, at: int) -> tuple[int, ...]:
        return (*self.fixed, at, *[_LEAST] * (len(KEYS) - len(self.fixed) - 1))


def _cell(intervals: list[tuple[tuple[int, ...], int, int]], probes: int) -> Column:
    """Number of the cell between two candidates that a row lies in, null for none."""
    arms = []
    for number, (fixed, low, high) in enumerate(intervals):
        step = -(-(high - low) // probes)
        name = KEYS[len(fixed)]
        inside = [f"{key} = {_long(value)}" for key, value in zip(KEYS, fixed)]
        inside += [f"{name} >= {_long(low)}", f"{name} <= {_long(high - 1)}"]
        offset = f"(CAST({name} AS DECIMAL(20,0)) - CAST('{low}' AS DECIMAL(20,0)))"
        arms.append(f"WHEN {' AND '.join(inside)} THEN {number * probes} + {offset} DIV {step}")
    return F.expr(f"CAST(CASE {' '.join(arms)} END AS INT)")


def _long(value: int) -> str:
    return f"CAST('{value}' AS BIGINT)"


def splitters(
    keys: DataFrame, shards: int, probes: int = PROBES, tolerance: float = TOLERANCE
) -> list[tuple[int, ...]]:
    """Values of ``KEYS`` at which the shards after the first begin.

    ``keys`` has these columns and ``size``.  The driver sees the sums of at most
    ``shards * probes`` cells a round.
    """
    ends = [end(name) for name in KEYS[1:] for end in (F.min, F.max)]
    total, *ends = keys.agg(F.sum("size"), *ends).first()
    if not total:
        return []
    ranges = [(0, 2**32), *((least, most + 1) for least, most in zip(ends[::2], ends[1::2]))]
    slack = tolerance * total / shards
    boundaries = [_Boundary(total * i / shards, *ranges[0]) for i in range(1, shards)]
    while opened := [b for b in boundaries if b.found is None]:
        intervals = list(dict.fromkeys(b.interval for b in opened))
        cells = keys.select(_cell(intervals, probes).alias("cell"), "size")
        counted = cells.where("cell IS NOT NULL").groupBy("cell").agg(F.sum("size").alias("size"))
        sums = dict(counted.collect())
        for boundary in opened:
            number = intervals.index(boundary.interval)
            step = -(-(boundary.high - boundary.low) // probes)
            low, end = boundary.low, boundary.high
            for cell in range(number * probes, (number + 1) * probes):
                high, held = min(low + step, end), sums.get(cell, 0)
                if high == end or boundary.below + held >= boundary.wanted:
                    break
                low, boundary.below = high, boundary.below + held
            under, over = boundary.wanted - boundary.below, boundary.below + held - boundary.wanted
            single = high - low == 1
            if min(under, over) <= slack or (single and len(boundary.fixed) == len(KEYS) - 1):
                boundary.found = boundary.key(low if under <= over else high)
            elif single:
                boundary.fixed += (low,)
                boundary.low, boundary.high = ranges[len(boundary.fixed)]
            else:
                boundary.low, boundary.high = low, high
    return sorted(b.found for b in boundaries)


def _reached(bound: tuple[int, ...]) -> str:
    """Whether a row's keys are at or beyond a bound."""
    test = "TRUE"
    for key, value in reversed(list(zip(KEYS, bound))):
        if value >= 2**63:  # one more than any
            test = "FALSE"
        elif value > _LEAST or test != "TRUE":
            test = f"({key} > {_long(value)} OR ({key} = {_long(value)} AND {test}))"
    return test


def _shard_of(bounds: list[tuple[int, ...]]) -> Column:
    return F.expr(" + ".join(f"CAST({_reached(bound)} AS INT)" for bound in bounds) or "0")


def shard_by_bytes(docs: DataFrame, shards: int = 16, tolerance: float = TOLERANCE) -> DataFrame:
    """Every row of ``docs`` with its shard and its place there.

    Returns ``row`` (all columns of the input), ``size`` (UTF-8 bytes of ``text``
    plus 1), ``crc``, ``shard`` and ``slot``, counted from 0 without gaps in key
    order.  A shard's bytes differ from its share by at most ``tolerance`` of a
    share or by one row.  A null text counts as empty, a null ``doc_id`` as the
    smallest; rows equal in both are cut apart like any others.  An empty table
    gives no row.
    """
    space = Workspace(docs.sparkSession)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    tagged = docs.select(
        whole_row(docs),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(_LEAST)).alias("tie"),
        F.monotonically_increasing_id().alias("number"),
    )
    tagged = space.keep(tagged)  # the numbers stay as they are
    bounds = splitters(tagged.select(*KEYS, "size"), shards, tolerance=tolerance)
    ordered = (
        tagged.withColumn("shard", _shard_of(bounds))
        .repartitionByRange("shard", *KEYS)
        .sortWithinPartitions("shard", *KEYS)
        .withColumn("at", F.monotonically_increasing_id())
    )
    placed = space.keep(ordered)
    part, place = F.shiftright("at", _ROW_BITS), F.col("at").bitwiseAND(2**_ROW_BITS - 1)
    placed = placed.withColumns({"part": part, "place": place}).drop("at", "tie", "number")
    pieces = placed.groupBy("shard", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("place").alias("first")
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        "shard", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift")
    )
    # One row for each written partition and shard: bounded by the partitions, not the rows.
    return placed.join(F.broadcast(starts), ["shard", "part"]).select(
        "row", "size", "crc", "shard", (F.col("place") + F.col("shift")).alias("slot")
    )
