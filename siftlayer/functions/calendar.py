"""Calendar and clock expressions.  They follow the session time zone (use UTC)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive hour ranges by part of day; all other hours are night.
DAY_PARTS = {"morning": (5, 11), "afternoon": (12, 16), "evening": (17, 20)}
OTHER_HOURS = "night"

# Spark numbers weekdays from 1 = Sunday to 7 = Saturday.
WEEKEND_DAYS = (1, 7)


def epoch_seconds(moment: Column) -> Column:
    """Whole seconds since the epoch; fractions are floored, also before 1970."""
    return moment.cast("timestamp").cast("long")


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Fractional minutes between the whole seconds of two moments."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60.0)


def day_part(
    moment: Column,
    parts: Mapping[str, tuple[int, int]] = DAY_PARTS,
    otherwise: str = OTHER_HOURS,
) -> Column:
    """Name of the hour range that ``moment`` falls in; null moments get ``otherwise``."""
    hour = F.hour(moment)
    labels = [F.when(hour.between(lo, hi), F.lit(name)) for name, (lo, hi) in parts.items()]
    return F.coalesce(*labels, F.lit(otherwise))


def is_weekend(moment: Column) -> Column:
    """True on Saturday and Sunday, null for a null moment."""
    return F.dayofweek(moment).isin(*WEEKEND_DAYS)
