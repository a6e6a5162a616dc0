"""Keep the rows that satisfy every declared rule."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def non_negative(column: str) -> Column:
    return F.col(column) >= 0.0


def positive(column: str) -> Column:
    return F.col(column) > 0


def not_before(column: str, earlier: str) -> Column:
    return F.col(column) >= F.col(earlier)


def all_of(rules: Iterable[Column]) -> Column:
    """Conjunction of rules under three-valued logic."""
    return reduce(and_, rules)


def keep_valid(df: DataFrame, rules: Iterable[Column]) -> DataFrame:
    """Keep rows for which all rules are true; a rule that is null drops the row."""
    return df.filter(all_of(rules))
