"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from orebed.llm import quality, toxicity
from orebed.llm.chat import format_conversations
from orebed.llm.common import table
from orebed.llm.decontaminate import find_leaks
from orebed.llm.mixing import mix
from orebed.llm.near_dup import near_duplicates
from orebed.llm.search import search
from orebed.llm.secrets import BASE_RULES, find_secrets, span_list
from orebed.llm.sharding import shard_list
from orebed.llm.sketch import compare_with_edit
from orebed.llm.substring import remove_repeats
from orebed.llm.tokens import read_documents, word_tokenizer, write_tokens
from orebed.llm.variants import group_variants
from orebed.session import fresh_dir

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op7_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=13)


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["kind"].isin([rule.kind for rule in BASE_RULES]))
    return found.select(
        "doc_id",
        *[of(rule.kind) for rule in BASE_RULES],
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, cap=2.0)


@query
def op2_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edit(table(spark, sf_dir, "documents"))


@query
def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, word_tokenizer(), end_id=1)
    return read_documents(spark, path)


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5, fold=0)


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=3, fold=1)


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_conversations(table(spark, sf_dir, "conversations"))


@query
def op11_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_list(table(spark, sf_dir, "documents"), weights=[1.0] * 40, grown=[1.0] * 41)


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents"), every=199, least_length=6, least_count=5)


@query
def op13_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


REGISTRY["pipeline"] = corpus_pipeline.run
