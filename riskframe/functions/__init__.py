"""Column-expression helpers (JVM-side, whole-stage-codegen friendly)."""

from riskframe.functions.hashing import uniform_hash, hash_hex
from riskframe.functions.numeric import sig_round, sig_round_sql
from riskframe.functions.measures import (
    yes_no_to_int, split_measure, extract_unit, extract_number, to_numeric,
    parse_measure,
)

__all__ = [
    "uniform_hash", "hash_hex", "sig_round", "sig_round_sql", "yes_no_to_int",
    "split_measure", "extract_unit", "extract_number", "to_numeric", "parse_measure",
]
