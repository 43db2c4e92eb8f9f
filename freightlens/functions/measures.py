"""Aggregate expressions shared by all reports.

Sums of decimals and integers are exact. Means are sum/count, rounded on their decimal value: the last
bits of a sum of doubles, which depend on the order in which partitions are merged, do not show.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up(c, digits: int) -> Column:
    """Round half up on the decimal value of a double.

    A quotient such as 264.6 / 8 may sit one unit in the last place below its tie; going through
    six more decimals rounds the number that was meant.
    """
    return F.round(as_col(c).cast(f"decimal(38,{digits + 6})"), digits).cast("double")


def half_even(c, digits: int) -> Column:
    return F.bround(as_col(c).cast(f"decimal(38,{digits + 6})"), digits).cast("double")


def ratio(num, den, digits: int | None = None, scale: float = 1.0) -> Column:
    """num / den * scale, NULL for a zero or NULL denominator."""
    n = as_col(num)
    q = F.try_divide(n * scale if scale != 1.0 else n, as_col(den)).cast("double")
    return q if digits is None else half_up(q, digits)


def rows(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def filled(c, alias: str) -> Column:
    return F.count(as_col(c)).alias(alias)


def rows_if(cond, alias: str) -> Column:
    return F.count_if(cond).alias(alias)


def ids(c, alias: str) -> Column:
    return F.count_distinct(as_col(c)).alias(alias)


def total(c, alias: str) -> Column:
    return F.sum(as_col(c)).cast("double").alias(alias)


def total_or_zero(c, alias: str) -> Column:
    """Sum in which NULLs count as zero (an all-NULL group gives 0)."""
    return F.coalesce(F.sum(as_col(c)).cast("double"), F.lit(0.0)).alias(alias)


def whole(c, alias: str) -> Column:
    return F.sum(as_col(c)).cast("long").alias(alias)


def mean_of(c) -> Column:
    c = as_col(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def mean(c, alias: str, digits: int | None = 2) -> Column:
    m = mean_of(c)
    return (m if digits is None else half_up(m, digits)).alias(alias)


def largest(c, alias: str) -> Column:
    return F.max(as_col(c)).cast("double").alias(alias)


def smallest(c, alias: str) -> Column:
    return F.min(as_col(c)).cast("double").alias(alias)


def share_of(cond) -> Column:
    return F.try_divide(F.count_if(cond).cast("double"), F.count(F.lit(1)))


def share(cond, alias: str, digits: int | None = 2) -> Column:
    """Percentage of all rows that satisfy cond."""
    p = ratio(F.count_if(cond), F.count(F.lit(1)), None, 100)
    return (p if digits is None else half_up(p, digits)).alias(alias)


def grand_total(df, expr: Column) -> Column:
    """One aggregate over df as a scalar subquery (no cross join)."""
    return df.agg(expr.alias("grand_total")).scalar()
