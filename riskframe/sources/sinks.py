"""Result sinks: metric and profile tables are written, not printed."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_results(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
