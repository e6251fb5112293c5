"""Registered queries of the text operators, each over its whole table."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import (bpe_stream, chat_format, maxscore, mixing, paragraph_sketch, part_codes, pii, quality,
                            severity, sharding, simhash, spelling, token_counts)
from gaugeworks.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
SHARDS = 40
# Shares go with tokens to these powers: large sources and languages are flattened.
MIX_POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}
MIX_SHARE = 0.7


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path(TOKENIZER), limit=1024)


def op2_pii_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.detect(docs, pii.train(docs))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = mixing.sample(table(spark, sf_dir, "documents"), mixing.text_form(), MIX_POWERS, MIX_SHARE)
    return kept.select("doc_id", "source", "lang", "topic", "n_tokens",
                       F.round("probability", 6).alias("probability"))


def op4_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return severity.score(docs, severity.train(docs, table(spark, sf_dir, "labels")))


def op5_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = maxscore.integers(table(spark, sf_dir, "embeddings"), scale=64)
    return maxscore.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=2)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op9_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_sketch.fingerprints(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(
        [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
        said.schema)
    log = chat_format.log_of(said.unionByName(tricky))
    return chat_format.digests(chat_format.conversations(log))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op12_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_codes.codes(table(spark, sf_dir, "embeddings"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.vocabulary(spelling.occurrences(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_pii_skip_chain": op2_pii_skip_chain,
    "op3_mixing": op3_mixing,
    "op4_severity": op4_severity,
    "op5_maxscore": op5_maxscore,
    "op6_simhash": op6_simhash,
    "op7_sharding": op7_sharding,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_paragraph_sketch": op9_paragraph_sketch,
    "op10_chat_format": op10_chat_format,
    "op11_quality": op11_quality,
    "op12_part_codes": op12_part_codes,
    "op13_spelling": op13_spelling,
}

_CONTROL = r"\\|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|</s>|<\|role\|>|<\|text\|>|<\|end\|>"

ORACLES: dict[str, str] = {
    "op10_chat_format": f"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        sized AS (
            SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL}'))
                + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 4
                  ELSE 23 + length(role) + len(regexp_extract_all(role, '{_CONTROL}')) END AS chars
            FROM said),
        whole AS (
            SELECT conv_id, count(*) AS n_turns, CAST(sum(chars) AS BIGINT) AS formatted_chars,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
                   coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                            FILTER (WHERE role = 'assistant'), '') AS loss
            FROM sized GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
               sha256(loss) AS loss_sha256, formatted_chars FROM whole""",
    # The sample vectors have 64 components, so a part has eight.
    "op12_part_codes": part_codes.codes_sql(width=8),
    "op3_mixing": mixing.sampling_sql(MIX_POWERS, MIX_SHARE),
    "op5_maxscore": """
        WITH v AS (
            SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, vec_id, score,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM scored QUALIFY rank <= 20""",
}
