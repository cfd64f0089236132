"""Column expressions shared by the marts. All are built-in Catalyst expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# 100.0 as a decimal(4,1) literal, the same type the SQL text ``* 100.0`` gives,
# so percentages come out as decimal(27,2) like the reference's CTAS.
HUNDRED = Decimal("100.0")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Whole hours from ``start`` to ``end``, truncated toward zero (TIMESTAMPDIFF(HOUR, ...))."""
    return F.timestamp_diff("HOUR", _col(start), _col(end))


def count_where(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END): 0 for the null row of an outer join."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def weighted_count_where(cond: Column, weight: Column | str) -> Column:
    """Like ``count_where`` when every input row stands for ``weight`` joined rows."""
    return F.sum(F.when(cond, _col(weight)).otherwise(F.lit(0)))


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """part * 100.0 / NULLIF(whole, 0), unrounded (null when whole is 0 or null)."""
    return (_col(part) * F.lit(HUNDRED)) / F.nullif(_col(whole), F.lit(0))


def safe_percent(part: Column | str, whole: Column | str, scale: int = 2) -> Column:
    """ROUND(part * 100.0 / NULLIF(whole, 0), scale)."""
    return F.round(percent_of(part, whole), scale)
