"""Sums and means of doubles that are the same on every run, whatever the order of rows.

Doubles are not associative: the last bits of their sum depend on how rows fall into partitions. Here each value becomes a
whole number of small units first, and whole numbers add up exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal digits of a unit, and bits of the lower of the two halves that are summed apart.
DIGITS, LOW_BITS = 9, 22

_WIDE = "decimal(38, 0)"


def to_units(value: Column, digits: int = DIGITS) -> Column:
    """The value as a whole number of units of ``10 ** -digits``; null stays null.

    A value that is no number, or of 2 ** 63 units or more, is an error.
    """
    return F.rint(value.cast("double") * F.lit(float(10**digits))).cast("bigint")


def sum_of_units(units: Column) -> Column:
    """Exact sum (an aggregate) of whole numbers, null where there are none.

    Two sums of longs, so it runs in generated code and no group below 10 ** 12 rows can overflow.
    """
    high = F.sum(F.shiftright(units, LOW_BITS)).cast(_WIDE)
    low = F.sum(units.bitwiseAND(F.lit((1 << LOW_BITS) - 1))).cast(_WIDE)
    return high * F.lit(1 << LOW_BITS).cast("decimal(8, 0)") + low


def mean_of_units(units: Column, places: int = 2, digits: int = DIGITS) -> Column:
    """Mean (an aggregate) of values given in units, rounded half up to ``places``; null where there are none.

    ``units`` should be a column and not an expression, which would be evaluated three times.
    """
    if not 0 <= places < digits:
        raise ValueError(f"places must be from 0 to {digits - 1}")
    total = sum_of_units(units)
    # So many units are one step of the last place of the sum of all rows; none without rows.
    step = F.nullif(F.count(units).cast(_WIDE) * F.lit(10 ** (digits - places)), F.lit(0).cast(_WIDE))
    # Half up, away from zero, in whole numbers.
    steps = F.call_function("div", F.abs(total) * F.lit(2) + step, step * F.lit(2))
    return F.when(total < 0, -steps).otherwise(steps).cast("double") / F.lit(float(10**places))
