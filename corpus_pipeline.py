"""From raw documents to tokens: five stages, each a table that the next one reads."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from netaudit.llm import bpe, decontaminate, jaccard, pii, quality
from netaudit.llm.common import checkpointed, shipped, table

#: Vocabulary of the last stage; every executor can open it.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@shipped
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    return quality.good_rows(docs, table(spark, sf_dir, "labels")).select(*docs.columns)


@shipped
def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return jaccard.one_of_each(docs).select(*docs.columns)


@shipped
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


@shipped
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.masked(docs)


@shipped
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of each document."""
    return bpe.encoded(docs, VOCABULARY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("near_duplicates", one_per_group),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("tokens", tokens),
]

#: The classifier and the tokenizer are not SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
