"""Row order on disk, so that readers can skip files by their min/max statistics.

Both operators change where rows lie and nothing else.  ``spread`` splits runs
of equal clustering keys: range partitioning sends equal keys to one task, so
a key with a third of all rows would become one huge task without it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEY = "_morton_key"
_SLOT = "_slot_{}"
_SPREAD = "_spread"
_SKETCH_GROUPS = 256
_RANKABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def file_position() -> Column:
    """A spread for rows scanned from parquet: a hash of file and row number.

    It is the same on every attempt at a task, unlike a random number, and it
    tells apart rows that are copies of each other.
    """
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def _in_range_order(
    df: DataFrame, columns: Sequence[str], spread: Column | None, partitions: int | None
) -> DataFrame:
    ranges = [F.col(c) for c in columns] + ([] if spread is None else [spread])
    # Without a fixed number AQE merges small neighbours into files of its
    # advisory size; neighbours in range order stay neighbours.
    sized = (
        df.repartitionByRange(*ranges)
        if partitions is None
        else df.repartitionByRange(partitions, *ranges)
    )
    return sized.sortWithinPartitions(*columns)


def order_by_range(
    df: DataFrame,
    columns: Sequence[str],
    spread: Column | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Linear order: best for filters on a prefix of ``columns``."""
    return _in_range_order(df, columns, spread, partitions)


def quantile_bounds(
    df: DataFrame, columns: Sequence[str], bits: int
) -> dict[str, list[float]]:
    """Up to ``2 ** bits - 1`` ascending cut points per column, in one pass.

    Every task makes one sketch per column.  Sketches merge in two steps: first
    within ``_SKETCH_GROUPS`` groups of tasks, then those few with each other, so
    that no task receives one sketch from every other.
    """
    steps = 2**bits
    shares = [i / steps for i in range(1, steps)]
    for c in columns:
        if not isinstance(df.schema[c].dataType, _RANKABLE):
            raise TypeError(f"column {c!r} cannot be ranked: {df.schema[c].dataType}")
    size = F.lit(max(200, min(65535, 16 * steps)))
    group = F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("_group")
    ranks = [_rank_value(df, c).alias(f"_v{i}") for i, c in enumerate(columns)]
    numbers = range(len(columns))
    per_group = df.select(group, *ranks).groupBy("_group").agg(
        *(F.kll_sketch_agg_double(_finite(f"_v{i}"), size).alias(f"_s{i}") for i in numbers),
        *(F.count(_finite(f"_v{i}")).alias(f"_n{i}") for i in numbers),
    )
    merged = per_group.agg(
        *(F.kll_merge_agg_double(F.when(F.col(f"_n{i}") > 0, F.col(f"_s{i}"))).alias(f"_s{i}") for i in numbers),
        *(F.sum(f"_n{i}").alias(f"_n{i}") for i in numbers),
    )
    wanted = F.array(*map(F.lit, shares))
    cuts = merged.select(
        *(
            F.when(F.col(f"_n{i}") > 0, F.kll_sketch_get_quantile_double(f"_s{i}", wanted)).alias(c)
            for i, c in enumerate(columns)
        )
    ).first()
    return {c: sorted(set(cuts[i] or [])) for i, c in enumerate(columns)}


def _finite(column: str) -> Column:
    value = F.col(column)
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(math.inf)), value)


def _rank_value(df: DataFrame, column: str) -> Column:
    """The column as a double, so that all rankable types share one code path."""
    data_type = df.schema[column].dataType
    value = F.col(column)
    if isinstance(data_type, T.DateType):
        value = F.unix_date(value)
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    return value.cast("double")


def _add_slot(df: DataFrame, column: str, slot: str, bounds: Sequence[float]) -> DataFrame:
    """Number of bounds at or below the value, found bit by bit."""
    bits = len(bounds).bit_length()
    padding = ["null"] * (2**bits - 1 - len(bounds))
    table = F.expr(f"array({', '.join([f'{b!r}D' for b in bounds] + padding)})")
    value = _rank_value(df, column)
    found = df.withColumn(slot, F.lit(0))
    for bit in reversed(range(bits)):
        step = 1 << bit
        # A comparison with padding, or of a null value, is null: no step.
        found = found.withColumn(
            slot,
            F.col(slot)
            + F.when(value >= F.get(table, F.col(slot) + (step - 1)), step).otherwise(0),
        )
    return found


def _interleaved(slots: Sequence[tuple[str, int]]) -> Column:
    """One key from slots of so many bits each, taking their highest bits first."""
    widest = max(bits for _, bits in slots)
    order = [
        (slot, bits - 1 - level)
        for level in range(widest)
        for slot, bits in slots
        if level < bits
    ]
    key = F.lit(0).cast("bigint")
    for place, (slot, bit) in enumerate(reversed(order)):
        digit = F.shiftright(F.col(slot), bit).bitwiseAND(F.lit(1)).cast("bigint")
        key = key.bitwiseOR(F.shiftleft(digit, place))
    return key


def order_by_morton_key(
    df: DataFrame,
    columns: Sequence[str],
    bounds: Mapping[str, Sequence[float]],
    spread: Column | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Z-order: useful for filters on any of ``columns``.

    Values are ranked against ``bounds`` (see :func:`quantile_bounds`) and the
    bits of the ranks are interleaved into one key.
    """
    slots = [(_SLOT.format(i), len(bounds[c]).bit_length()) for i, c in enumerate(columns)]
    if sum(bits for _, bits in slots) > 63:
        raise ValueError(f"the bounds of {list(columns)} do not fit a 64-bit key")
    if not any(bits for _, bits in slots):
        return df  # nothing but nulls to order by
    ranked = df if spread is None else df.withColumn(_SPREAD, spread)
    for column, (slot, _) in zip(columns, slots):
        ranked = _add_slot(ranked, column, slot, bounds[column])
    keyed = ranked.withColumn(_KEY, _interleaved(slots)).drop(*(slot for slot, _ in slots))
    placed = _in_range_order(
        keyed, [_KEY], None if spread is None else F.col(_SPREAD), partitions
    )
    return placed.drop(_KEY, _SPREAD)
