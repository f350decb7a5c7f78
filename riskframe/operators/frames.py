"""Inspection and projection operators.

Schema questions are answered from driver metadata (no job); row questions
are Spark actions or lazy projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def shape(df: DataFrame) -> DataFrame:
    """One row: ``n_rows`` (a count job) and ``n_cols`` (metadata)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("int"))


def schema_frame(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, dtype string, nullable boolean")


def head(df: DataFrame, n: int = 5, by: str | list[str] | None = None) -> DataFrame:
    """First ``n`` rows in an explicit order (top-k: each partition keeps n)."""
    by = [by] if isinstance(by, str) else (by or [df.columns[0]])
    return df.orderBy(*by).limit(n)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def select_columns(df: DataFrame, cols: list[str] | list[bool]) -> DataFrame:
    if cols and isinstance(cols[0], bool):
        cols = [c for c, keep in zip(df.columns, cols) if keep]
    return df.select(*cols)


def dtype_columns(df: DataFrame, kind: str) -> list[str]:
    kinds = {"number": _NUMBER, "string": (T.StringType,), "bool": (T.BooleanType,)}
    want = kinds[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, want)]


def select_dtypes(df: DataFrame, kind: str = "number", exclude: list[str] | None = None) -> DataFrame:
    cols = [c for c in dtype_columns(df, kind) if c not in (exclude or [])]
    return df.select(*cols)


def move_last(df: DataFrame, col: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != col], col)


def if_column(df: DataFrame, col: str, fn) -> DataFrame:
    """Apply ``fn(df)`` only when ``col`` exists."""
    return fn(df) if col in df.columns else df


def bool_to_int(df: DataFrame) -> DataFrame:
    """Every boolean column becomes 0/1 int (F8)."""
    return df.select(*[F.col(f.name).cast("int").alias(f.name)
                       if isinstance(f.dataType, T.BooleanType) else F.col(f.name)
                       for f in df.schema.fields])


def to_long(df: DataFrame, cols: list[str], value_type: str = "double",
            name: str = "column", value: str = "value") -> DataFrame:
    """Unpivot ``cols`` to ``(column, value)`` so one ``groupBy(column)``
    computes a statistic for every column in one pass. NaN is a missing value."""
    def known(c: str) -> Column:
        x = F.col(c)
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            x = F.when(~F.isnan(x), x)
        return x.cast(value_type).alias(c)

    cast = df.select(*[known(c) for c in cols])
    return cast.unpivot([], cols, name, value)
