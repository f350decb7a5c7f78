"""The corpus pipeline: five stages from raw documents to training windows.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of documents, whatever these are, and handle nulls, empty
texts, repeated rows and empty tables as their operators say:

* ``language``: documents without letters, or whose predicted language scores
  under 0.4, go.
* ``near_duplicates``: one document of each class stays.
* ``decontaminate``: documents that contain an item of ``benchmark`` go.
* ``personal_data``: spans are replaced by their kind in angle brackets;
  ``n_chars`` follows the text.
* ``pack``: the windows' pieces, one row per piece.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import decontaminate, langid, near_dedup, packing, pii
from riskframe.llm.common import free_name
from riskframe.session import shared_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = free_name(docs, "__leaks")
    return decontaminate.matches(docs, items, into=leaks).where(F.size(leaks) == 0).drop(leaks)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    length = free_name(docs, "__length")
    masked = pii.mask(docs.withColumn(length, F.length("text")))
    if "n_chars" in docs.columns:
        changed = F.length("text") != F.col(length)
        masked = masked.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return masked.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", benchmark_free),
    ("personal_data", personal_data),
    ("pack", pack),
]

#: The stages rest on trained models, tokenizers and signatures: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
