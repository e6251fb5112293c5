"""Corpus pipeline: documents through five of the text operators, one stage after the other.

Toxic documents go; one document of each group of near copies stays; personal data is
replaced; sources, languages and forms of text are mixed to flatter weights; what is left
becomes token ids.  Every stage reads all rows its predecessor kept, and all but the last
return the columns of ``documents``.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm import bpe_stream, mixing, pii, severity, simhash
from gaugeworks.llm.common import staged, table

TOKENIZER = "byte_bpe_50k.json"
MIX_POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}
MIX_SHARE = 0.7

# Severity, signatures and personal data have no SQL form.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of any severity stays below the limit."""
    return severity.keep_clean(docs, severity.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.drop_similar(docs, width=5, similarity=0.8)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with every span of personal data replaced by its kind."""
    return pii.redact(docs, pii.train(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and forms have the targeted shares of tokens."""
    return mixing.mix(docs, mixing.text_form(), MIX_POWERS, MIX_SHARE)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``exact`` of every document left."""
    return bpe_stream.encode(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixture", mixture), ("token_ids", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; results between stages are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
