"""Sums of doubles that do not depend on the order of the rows.

Adding doubles rounds at every step, so a distributed sum depends on which partial sums meet first.
Here a value is first written as a decimal with ``SCALE`` places, and decimals add exactly in any order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 10
_SMALL = 1e17  # below: decimal(28, 10); from here on doubles are whole numbers: decimal(38, 0)
_LARGE = 1e27


def exact_sum(value: Column | str) -> Column:
    """Sum of a double column as a double, equal for every order and partitioning of the rows.

    Each value counts with ``SCALE`` decimal places (half up), the sum is exact, and only its conversion
    back to a double rounds. Nulls are left out; without values the sum is null. NaN and infinities
    count as doubles do (their sum has no order either). Finite values of 1e27 and more, beyond what a decimal
    sum of many can hold, are added as doubles.
    """
    x = F.col(value) if isinstance(value, str) else value
    size = F.abs(x)
    plain = F.sum(F.when(size < _SMALL, x).try_cast(f"decimal(28,{SCALE})"))
    whole = F.sum(F.when((size >= _SMALL) & (size < _LARGE), x).try_cast("decimal(28,0)"))
    rest = F.sum(F.when(~(size < _LARGE), x))
    zero = F.lit(0.0)
    parts = F.coalesce(plain.cast("double"), zero) + F.coalesce(whole.cast("double"), zero) + F.coalesce(rest, zero)
    return F.when(F.count(x) > 0, parts)
