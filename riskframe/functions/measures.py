"""Scalar cleaning functions: yes/no flags and unit-bearing measure strings
such as ``60Nm@3500rpm`` or ``40.36bhp@6000rpm``.

All are built-in expressions; a measure column is parsed in one ``select``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The flag spellings and the two extraction patterns.
YES, NO = "Yes", "No"
UNIT_PATTERN = "([a-zA-Z]+)"
NUMBER_PATTERN = "([0-9.]+)"
MEASURE_SEP = "@"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yes_no_to_int(c: Column | str) -> Column:
    """'Yes' -> 1, 'No' -> 0, anything else (other case, blank, null) -> null."""
    c = _c(c)
    return F.when(c == YES, F.lit(1)).when(c == NO, F.lit(0)).cast("int")


def split_measure(c: Column | str, part: int) -> Column:
    """Part 1 or 2 of ``a@b``; a missing part is null, not ''."""
    return F.nullif(F.split_part(_c(c), F.lit(MEASURE_SEP), F.lit(part)), F.lit(""))


def extract_unit(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_c(c), UNIT_PATTERN, 1), F.lit(""))


def extract_number(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_c(c), NUMBER_PATTERN, 1), F.lit(""))


def to_numeric(c: Column | str, strict: bool = True) -> Column:
    """Strict parse fails the job on a malformed number (ANSI cast); the
    lenient form yields null instead."""
    c = _c(c)
    return c.cast("double") if strict else c.try_cast("double")


def parse_measure(df: DataFrame, col: str, prefix: str, strict: bool = True,
                  drop: bool = True) -> DataFrame:
    """``max_torque`` -> ``Torque``, ``Torque_unit``, ``Torque_rpm``."""
    value_part = split_measure(col, 1)
    rpm_part = split_measure(col, 2)
    out = df.withColumns({
        prefix: to_numeric(extract_number(value_part), strict),
        f"{prefix}_unit": extract_unit(value_part),
        f"{prefix}_rpm": to_numeric(extract_number(rpm_part), strict),
    })
    return out.drop(col) if drop else out
