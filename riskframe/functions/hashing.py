"""Deterministic per-row randomness.

``rand()`` depends on partitioning, so a recomputed or repartitioned frame would
draw differently. Instead every random choice is a function of a stable row key
and a seed: ``md5(key || '|' || seed)``. The same expression is written in
DuckDB SQL for the oracles (``uniform_hash_sql``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits = 52 bits: exactly representable in a double.
_HEX_DIGITS = 13
_SCALE = float(16 ** _HEX_DIGITS)


def hash_hex(key: Column | str, seed: int | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def uniform_hash(key: Column | str, seed: int | str) -> Column:
    """u in [0, 1), uniform, fixed per (key, seed)."""
    h = hash_hex(key, seed)
    return F.conv(F.substring(h, 1, _HEX_DIGITS), 16, 10).cast("double") / F.lit(_SCALE)


def hash_hex_sql(key_sql: str, seed: int | str) -> str:
    return f"md5(CAST({key_sql} AS VARCHAR) || '|{seed}')"


def uniform_hash_sql(key_sql: str, seed: int | str) -> str:
    return (f"(CAST(('0x' || substr({hash_hex_sql(key_sql, seed)}, 1, {_HEX_DIGITS})) AS BIGINT)"
            f"::DOUBLE / {_SCALE!r})")
