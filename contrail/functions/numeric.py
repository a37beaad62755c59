"""Numeric helpers that give the same answer on every engine and partitioning.

Double sums depend on the order rows are added, and ``round(double)`` differs
between engines at ties.  Rounding through a wide decimal (HALF_UP on the
decimal text of the double) is stable in Spark and in ANSI SQL engines alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def half_up(x, n: int = 2) -> Column:
    """Round half away from zero at ``n`` decimals, result double."""
    return F.round(_c(x).cast("decimal(38,10)"), n).cast("double")


def exact_sum(x, scale: int = 10) -> Column:
    """Order-independent sum of a measure with at most ``scale`` decimals."""
    return F.sum(_c(x).cast(f"decimal(28,{scale})")).cast("double")


def ratio(num, den) -> Column:
    """num / den as double, null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(num, den, n: int | None = 2) -> Column:
    """100 * num / den, rounded half-up to ``n`` decimals (None: unrounded)."""
    v = ratio(_c(num).cast("double") * 100.0, den)
    return v if n is None else half_up(v, n)


def count_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as bigint (0 on empty groups)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def formatted(x, n: int = 2, suffix: str = "") -> Column:
    """Presentation text ('1,234.57 min').  The number is rounded
    half-up first, so the text agrees with the numeric column."""
    return F.concat(F.format_number(half_up(x, n), n), F.lit(suffix))
