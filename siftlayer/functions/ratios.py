"""Ratios that answer 0.0 instead of dividing by nothing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_quotient(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, else 0.0.

    A null denominator also gives 0.0; a null numerator over a positive
    denominator stays null.
    """
    return F.when(denominator > 0.0, numerator / denominator).otherwise(F.lit(0.0))


def guarded_percentage(part: Column, whole: Column) -> Column:
    """Share of ``part`` in ``whole`` in percent, with the same guard."""
    return F.when(whole > 0.0, part / whole * 100.0).otherwise(F.lit(0.0))
