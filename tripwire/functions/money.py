"""Money aggregation and rounding.

Amounts are doubles on the wire.  A sum adds the amounts that a decimal(28,8)
holds without change (all ordinary money) as decimals, which is exact and
independent of row order, and the others (finer or very large ones) as doubles:
no row is rounded before it is added, and none is skipped.  NaN counts as a
missing amount.  Averages divide by the number of rows that were summed.
Report rounding is half-even (``bround``), the rounding of the numeric library
the report tables were made with.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,8)"


def present(c: Column | str) -> Column:
    """The amount, NULL where it is NaN."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(col), col)


def money_parts(c: Column | str) -> tuple[Column, Column]:
    """The two sums a total is made of: of amounts held as decimals, and of the others."""
    col = present(c)
    exact = col.try_cast(EXACT)
    kept = F.coalesce(exact.cast("double") == col, F.lit(False))
    return F.sum(F.when(kept, exact)), F.sum(F.when(~kept, col))


def _total(decimals: Column, doubles: Column) -> Column:
    return F.coalesce(decimals.cast("double") + doubles, decimals.cast("double"), doubles)


def money_sum(c: Column | str) -> Column:
    return _total(*money_parts(c))


def money_merged(exact: Column, rest: Column) -> Column:
    """The total of stored ``money_parts``."""
    return _total(F.sum(exact), F.sum(rest))


def money_sum0(c: Column | str) -> Column:
    """Sum that is 0.0 (not NULL) over no amounts."""
    return F.coalesce(money_sum(c), F.lit(0.0))


def money_avg(c: Column | str) -> Column:
    return money_sum(c) / F.count(present(c))


def round2(c: Column) -> Column:
    return F.bround(c, 2)


def pct(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; 0 when ``whole`` is not positive."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))
