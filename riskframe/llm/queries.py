"""Registered queries of the corpus operators: thin wrappers that read the
intended table and derive the returned columns from the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (decontaminate, html_extract, jaccard_join, langid, lm_score, near_dedup, packing, pii,
                           prefix_trie, resampling, token_counts, token_files, topk)
from riskframe.llm.common import table
from riskframe.llm.oracles import ORACLES  # noqa: F401  (the SQL of these queries)
from riskframe.session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_files(spark, sf_dir):
    path = shared_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path,
                                  public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_token_files(spark, path, with_ids=False)


@query
def op2_pack_documents(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        with_ids=False)


@query
def op4_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_near_duplicates(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op6_personal_data(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op3_benchmark_leaks(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_main_text(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op8_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op9_lm_scores(spark, sf_dir):
    return lm_score.score(table(spark, sf_dir, "documents"))


@query
def op12_conversation_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query
def op11_importance_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_jaccard_components(spark, sf_dir):
    return jaccard_join.components(table(spark, sf_dir, "documents"))
