"""SQL text helpers for the oracle: the same rounding rules as
``insights.functions.numeric`` (ratios rounded through an integer)."""

from __future__ import annotations


def RATIO(num: str, den: str, digits: int = 2, scale: float = 1.0) -> str:
    f = 10.0 ** digits
    return (f"(round(CAST({scale * f!r} AS DOUBLE) * CAST({num} AS DOUBLE) "
            f"/ nullif(CAST({den} AS DOUBLE), 0.0)) / {f!r})")


def PCT(num: str, den: str, digits: int = 2) -> str:
    return RATIO(num, den, digits, 100.0)


def AVG(c: str, digits: int = 2) -> str:
    return RATIO(f"sum({c})", f"count({c})", digits)


def RD(c: str, digits: int = 2) -> str:
    f = 10.0 ** digits
    return f"(round(CAST({c} AS DOUBLE) * {f!r}) / {f!r})"


def MONEY(c: str) -> str:
    return f"CAST(round({c}, 2) AS DECIMAL(18,2))"
