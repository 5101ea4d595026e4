"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from netaudit.llm import bpe, decontaminate, infill, jaccard, lexical, mainhtml, passages, pii, quality, tokenstore, toolchat, toxicity, vectors
from netaudit.llm.common import shipped, table
from netaudit.llm.sql import LLM_ORACLE
from netaudit.session import job_folder


def op3_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_ngram_jaccard_join(spark, sf_dir):
    return jaccard.shingle_components(table(spark, sf_dir, "documents"))


def op1_pii(spark, sf_dir):
    return pii.pii_digests(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark, sf_dir):
    return passages.passage_digests(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The tool that the turns of a user stand for, with the bounds of a question's length in words.
ASK = [("ask", "question", "string", True, None, None), ("ask", "turn", "integer", True, 0.0, None), ("ask", "words", "integer", True, 1.0, 40.0)]


def op7_chat_formatting(spark, sf_dir):
    """Turns of users as calls of a tool, turns of assistants as results of the turn before, all others as messages.

    A call needs the one two turns before; in every seventh conversation the one two turns later.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")

    def call_id(turn):
        return F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))

    words = F.size(F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")).cast("long")
    placed = "conv_id is not null and turn is not null"
    messages = turns.filter(f"not coalesce(role in ('user', 'assistant') and {placed}, false)").withColumnRenamed("text", "content")
    turns = turns.filter(placed)
    calls = turns.filter("role = 'user'").select(
        "conv_id", call_id(F.col("turn")).alias("call_id"), "turn", F.lit("ask").alias("name"),
        F.to_json(F.struct(words.alias("words"), F.col("text").alias("question"), F.col("turn").alias("turn"))).alias("arguments"),
    )
    results = turns.filter("role = 'assistant'").select("conv_id", call_id(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    needed = F.col("turn") + F.when(F.col("conv_id") % 7 == 0, 2).otherwise(-2)
    needs = calls.select("conv_id", "call_id", call_id(needed).alias("needed"))
    schemas = spark.createDataFrame(ASK, "name string, field string, kind string, required boolean, least double, most double")
    return toolchat.linked(calls, results, schemas, needs, messages)


def op8_embedding_near_dedup(spark, sf_dir):
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_bpe_roundtrip(spark, sf_dir):
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_html_extraction(spark, sf_dir):
    return mainhtml.extracted(table(spark, sf_dir, "pages"))


def op11_fill_in_middle(spark, sf_dir):
    return infill.infill_digests(table(spark, sf_dir, "documents"))


def op12_token_store(spark, sf_dir):
    path = job_folder(spark, "tokens")
    tokenstore.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenstore.token_digests(spark, path)


def op13_ranked_search(spark, sf_dir):
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES = {f.__name__: shipped(f) for f in (op1_pii, op2_substring_dedup, op3_toxicity, op4_benchmark_decontamination, op5_ngram_jaccard_join, op6_quality_classifier, op7_chat_formatting, op8_embedding_near_dedup, op9_bpe_roundtrip, op10_html_extraction, op11_fill_in_middle, op12_token_store, op13_ranked_search)}
LLM_QUERIES["pipeline"] = corpus_pipeline.run

