"""Grouped metrics: one partial aggregate per task, one shuffle on the group keys.

No sum depends on the order in which tasks finish, so reruns are bit for bit
equal.  Doubles are added exactly: each is cut into the integers that stand in
cells of 24 bits, the cells are added as integers, and the total is rounded once
it is complete.  Bits below the last cell, 2^-72, are rounded value by value.

``scale`` on a measure switches to fixed-point arithmetic instead: values are taken
as whole units of ``10 ** -scale``.  It is meant for finite values with at most
``scale`` decimals, and stops the job on values with more decimals, NaN,
infinities and overflow.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlayer.functions.ratios import guarded_quotient

_MAX_INT = 2**31 - 1

# The cells begin at 2^48, 2^24, 1, 2^-24, 2^-48 and 2^-72.  A group of 2^39 values
# fits the 64 bits of each.  Doubles of 2^70 and more, NaN and infinities are added as
# they are.
_CELL = 24
_CELLS = (48, 24, 0, -24, -48, -72)
_TOO_LARGE = 2.0**70


def _cells(value: Column) -> list[Column]:
    """The integers that a double is made of, one for each cell; null for what has none.

    Rounding to whole units of a cell is exact but for the bits below it, and so is
    taking away what the cell above has.
    """
    held = F.when(F.abs(value) < _TOO_LARGE, value)
    units = [F.rint(held * F.lit(2.0**-place)) for place in _CELLS]
    above = [F.lit(0.0), *(unit * F.lit(2.0**_CELL) for unit in units)]
    return [(unit - higher).cast("bigint") for unit, higher in zip(units, above)]


def _exact_total(value: Column) -> Column:
    added = [F.sum(cell) for cell in _cells(value)]
    # Carry what a cell holds beyond its bits, from the lowest up; then each but the
    # highest is a number from -2^23 to 2^23 - 1, and no two cancel each other.
    digits, carry = [], F.lit(0).cast("bigint")
    for cell in reversed(added[1:]):
        full = cell + carry
        carry = F.shiftright(full + F.lit(2 ** (_CELL - 1)), _CELL)
        digits.append((full - F.shiftleft(carry, _CELL)).cast("double"))
    sixth, fifth, fourth, third, second = digits
    top = (added[0] + carry).cast("double")
    # Exact up to 2^53, as are both parts of the fraction: what is lost where whole and
    # fraction meet is found again, so that the last addition alone rounds.
    whole = top * 2.0**48 + (second * 2.0**24 + third)
    upper, lower = (fourth * 2.0**24 + fifth) * 2.0**-48, sixth * 2.0**-72
    near = whole + upper
    finite = near + ((upper - (near - whole)) + lower)
    others = F.sum(F.when((F.abs(value) >= _TOO_LARGE) | F.isnan(value), value))
    return F.when(others.isNull(), finite).when(added[0].isNull(), others).otherwise(others + finite)


def _fixed_point_total(value: Column, scale: int) -> Column:
    scaled = value * float(10**scale)
    # What a double with so many decimals is off by, at most, after the product.
    slack = F.abs(scaled) * 2.0**-50 + 1e-9
    whole_units = F.when(F.abs(scaled - F.rint(scaled)) <= slack, F.rint(scaled))
    units = whole_units.try_cast("bigint")
    checked = F.when(value.isNull() | units.isNotNull(), units).otherwise(
        F.raise_error(F.lit("value has no fixed-point form")).cast("bigint")
    )
    added = F.try_sum(checked)
    whole = F.when((F.count(value) == 0) | added.isNotNull(), added).otherwise(
        F.raise_error(F.lit("fixed-point sum overflows")).cast("bigint")
    )
    return whole / F.lit(float(10**scale))


def _total(value: Column, scale: int | None) -> Column:
    value = value.cast("double")
    return _exact_total(value) if scale is None else _fixed_point_total(value, scale)


def row_count(name: str, type_name: str = "int") -> Column:
    """Rows per group, nulls included.

    ``int`` never wraps around: a group too large for it stops the job whatever
    the session says about overflow.  Use ``bigint`` for such groups.
    """
    rows = F.count(F.lit(1))
    if type_name == "bigint":
        return rows.alias(name)
    if type_name != "int":
        raise ValueError(f"a row count is 'int' or 'bigint', not {type_name!r}")
    too_many = F.raise_error(F.lit(f"{name}: group too large for int, use bigint"))
    return F.when(rows <= _MAX_INT, rows.cast("int")).otherwise(too_many.cast("int")).alias(name)


def total(value: Column, name: str, scale: int | None = None) -> Column:
    """Sum over the non-null values; null when there are none."""
    return _total(value, scale).alias(name)


def mean(value: Column, name: str, scale: int | None = None) -> Column:
    """Average over the non-null values; null when there are none."""
    values = F.count(value)
    return F.when(values > 0, _total(value, scale) / values).alias(name)


def ratio_of_totals(
    numerator: Column,
    denominator: Column,
    name: str,
    scale: int | None = None,
    denominator_scale: int | None = None,
) -> Column:
    """Total over total where the lower one is positive, else 0.0."""
    lower = scale if denominator_scale is None else denominator_scale
    return guarded_quotient(_total(numerator, scale), _total(denominator, lower)).alias(name)


def summarise(df: DataFrame, keys: Mapping[str, Column], *measures: Column) -> DataFrame:
    """Group by ``keys`` (name to expression) and compute ``measures``.

    Null keys form groups of their own.
    """
    return df.groupBy(*(column.alias(name) for name, column in keys.items())).agg(*measures)
