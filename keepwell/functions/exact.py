"""Sums, means and ratios that come out the same however Spark orders the rows.

Money has at most four decimals, so it is added as DECIMAL: partial sums then merge exactly and a
re-run after a lost executor gives the same digits. The results go back to DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,4)"


def money(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def total(column, digits: int = 2) -> Column:
    return F.round(F.sum(money(column)), digits).cast("double")


def mean(column, digits: int = 2) -> Column:
    return F.round(F.avg(money(column)), digits).cast("double")


def ratio(part: Column, whole: Column, digits: int = 2, scale: int = 1) -> Column:
    """scale * part / whole, rounded half up; null where whole is zero."""
    top = part.cast("decimal(20,4)") * F.lit(scale)
    return F.round(F.try_divide(top, whole.cast("decimal(20,4)")), digits).cast("double")


def correlation(a: str, b: str) -> Column:
    """Pearson correlation over the rows that have both values; null, not an error, when a column is constant there."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
