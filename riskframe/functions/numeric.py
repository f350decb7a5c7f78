"""Numeric presentation helpers shared by queries and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIG_DIGITS = 7


def sig_round(c: Column | str, digits: int = SIG_DIGITS) -> Column:
    """Round to ``digits`` significant digits (engine-independent summation
    order then no longer shows in the result)."""
    c = F.col(c) if isinstance(c, str) else c
    p = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))))
    k = float(10 ** (digits - 1))
    # floor(s * 10^k + 0.5): the same IEEE operations in every engine, so
    # half-way cases resolve identically (decimal HALF_UP would not).
    return (F.when(c.isNull() | (c == 0) | F.isnan(c), c)
            .otherwise(F.floor(c / p * F.lit(k) + F.lit(0.5)).cast("double") / F.lit(k) * p)
            .cast("double"))


def sig_round_sql(expr: str, digits: int = SIG_DIGITS) -> str:
    p = f"pow(10.0, floor(log10(abs({expr}))))"
    k = f"{float(10 ** (digits - 1))!r}::DOUBLE"
    return (f"CAST(CASE WHEN ({expr}) IS NULL OR ({expr}) = 0 OR isnan({expr}) THEN ({expr}) "
            f"ELSE CAST(floor(({expr}) / {p} * {k} + 0.5::DOUBLE) AS DOUBLE) / {k} * {p} END AS DOUBLE)")


def abs_round(c: Column | str, decimals: int = 6) -> Column:
    """Round to fixed decimals with the same IEEE steps as ``abs_round_sql``
    (for values near zero, where significant digits would amplify noise)."""
    c = F.col(c) if isinstance(c, str) else c
    k = float(10 ** decimals)
    return (F.floor(c * F.lit(k) + F.lit(0.5)).cast("double") / F.lit(k)).cast("double")


def abs_round_sql(expr: str, decimals: int = 6) -> str:
    k = f"{float(10 ** decimals)!r}::DOUBLE"
    return f"CAST(CAST(floor(({expr}) * {k} + 0.5::DOUBLE) AS DOUBLE) / {k} AS DOUBLE)"
