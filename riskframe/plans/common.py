"""Shared pieces of the registered queries."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.hashing import uniform_hash
from riskframe.functions.numeric import sig_round
from riskframe.sources import tables


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column to fixed significant digits so the result
    does not depend on summation order (the SQL oracles do the same)."""
    return df.select(*[sig_round(f.name).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else f.name
                       for f in df.schema.fields])


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.policies(spark, sf_dir)


def train_test_tables(spark: SparkSession, sf_dir: str):
    return tables.labelled_unlabelled(spark, sf_dir)


PROFILE_COLUMNS = [*tables.NUMERIC_COLUMNS, tables.LABEL]
STRING_COLUMNS = [*tables.CATEGORY_COLUMNS, *tables.MEASURE_COLUMNS, *tables.FLAG_COLUMNS]


SCORE_SEED = 7


def scored_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(policy_id, label, score) with a deterministic score computed from the
    row (a hash term plus a feature term, many ties), so every metric can be
    checked against SQL before any model exists."""
    p = policies(spark, sf_dir)
    return p.select(tables.KEY, F.col(tables.LABEL).alias("label"), fixture_score().alias("score"))


def fixture_score() -> Column:
    return (F.floor(uniform_hash(tables.KEY, SCORE_SEED) * 50) + F.col("n_lines") * 10) / 130
