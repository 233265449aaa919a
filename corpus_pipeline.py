"""A corpus from documents to token files, in five stages.

Each stage takes what the one before kept, as written and read again. The first four return documents;
the last writes token files and returns what it reads back from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orebed.llm.common import stored, table
from orebed.llm.decontaminate import clean_documents
from orebed.llm.mixing import mixed_documents
from orebed.llm.near_dup import distinct_documents
from orebed.llm.quality import good_documents
from orebed.llm.tokens import read_documents, word_tokenizer, write_tokens
from orebed.session import fresh_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return distinct_documents(docs, shingle=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the token files of the mix."""
    path = fresh_dir(spark, "corpus")
    write_tokens(docs, path, word_tokenizer(), end_id=1)
    return read_documents(spark, path)


STAGES = [
    ("quality", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

# A trained network, bit votes and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, f"stage-{place}")
    return docs
