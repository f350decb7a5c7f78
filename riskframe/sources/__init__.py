"""Sources and sinks: file readers, the driver-table adapter, result writers."""

from riskframe.sources.tables import (
    read_table, driver_table, policies, labelled_unlabelled, POLICY_COLUMNS,
    FLAG_COLUMNS, MEASURE_COLUMNS, CATEGORY_COLUMNS, NUMERIC_COLUMNS, LABEL, KEY,
)
from riskframe.sources.sinks import write_results

__all__ = [
    "read_table", "driver_table", "policies", "labelled_unlabelled", "write_results",
    "POLICY_COLUMNS", "FLAG_COLUMNS", "MEASURE_COLUMNS", "CATEGORY_COLUMNS",
    "NUMERIC_COLUMNS", "LABEL", "KEY",
]
