"""Numeric helpers with engine-independent rounding.

Money stays exact decimal.  Ratios (percentages, means) are computed in
double and rounded as ``round(10^d * x) / 10^d``: rounding a double to an
integer gives the same answer in every engine, which rounding to ``d``
decimal places does not (engines scale by ``10^d`` differently at the .5
edge).  The SQL twins in ``insights.oracle.sqlfn`` apply the same rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_OUT = "decimal(18,2)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str, digits: int = 2, scale: float = 1.0) -> Column:
    """``round(scale * num / den, digits)`` as a double; NULL when den is 0 or NULL."""
    f = 10.0 ** digits
    return F.round(F.lit(scale * f) * _c(num).cast("double")
                   / F.nullif(_c(den).cast("double"), F.lit(0.0))) / F.lit(f)


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """Percentage ``100 * num / den`` rounded to ``digits``."""
    return ratio(num, den, digits, 100.0)


def mean(total: Column | str, count: Column | str, digits: int = 2) -> Column:
    """Mean from an exact total and a count (never ``avg`` of doubles)."""
    return ratio(total, count, digits)


def avg_exact(c: Column | str, digits: int = 2) -> Column:
    """Aggregate: mean of an exact (int/decimal) column, rounded."""
    return mean(F.sum(_c(c)), F.count(_c(c)), digits)


def round_double(c: Column | str, digits: int = 2) -> Column:
    f = 10.0 ** digits
    return F.round(_c(c).cast("double") * F.lit(f)) / F.lit(f)


def money(c: Column | str) -> Column:
    """Exact decimal rounded HALF_UP to cents, as ``decimal(18,2)``."""
    return F.round(_c(c), 2).cast(MONEY_OUT)
