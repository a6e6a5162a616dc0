"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HASH = "_key_hash"
_ROW = "_kept"


def deduplicate(
    df: DataFrame,
    keys: Sequence[str],
    keep: str = "first",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Keep one row for each distinct combination of ``keys``.

    Keys that the frame lacks are skipped; two nulls count as equal.  ``keep``:

    * ``"first"`` - the smallest row by ``order_by`` and then by all remaining
      columns, nulls first.  The order is total, so a rerun, another
      partitioning or a lost executor gives the same rows again.
    * ``"any"`` - whichever row Spark meets first.

    Both are aggregates: every task reduces its rows to one per key before the
    shuffle, so a key with a third of all rows sends one row per task.
    """
    present = [k for k in keys if k in df.columns]
    if not present:
        raise ValueError(f"none of the keys {list(keys)} is a column of {df.columns}")
    payload = [c for c in df.columns if c not in present]
    if not payload:
        return df.distinct()
    if keep == "any":
        return df.dropDuplicates(present)
    if keep != "first":
        raise ValueError(f"keep must be 'first' or 'any', not {keep!r}")

    leading = [c for c in order_by if c in payload]
    ordered = leading + [c for c in payload if c not in leading]
    # Rows with text in them aggregate by sorting.  With a hash as the first
    # grouping column nearly every comparison ends at its 8-byte sort prefix
    # instead of walking through all keys; bench_rows.py has figures.
    grouped = df.groupBy(F.xxhash64(*present).alias(_HASH), *present).agg(
        F.min(F.struct(*ordered)).alias(_ROW)
    )
    return grouped.select(
        *(F.col(c) if c in present else F.col(f"{_ROW}.{c}").alias(c) for c in df.columns)
    )
