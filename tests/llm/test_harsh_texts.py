"""Texts without spaces, of one letter, of digits only, of very many lines: every operator takes them whole."""
from __future__ import annotations

import math
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gaugeworks.llm import (bpe_stream, chat_format, mixing, paragraph_sketch, pii, quality, severity, sharding, simhash,
                            spelling, token_counts)
from tests.conftest import SF_DIR

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["a" * 1_000_000, "1" * 5000 + ".1.2.3", "1.2.3." + "0" * 5000, "word\tand\tmore\t" * 60_000,
         "\n".join(f"l{i % 50}" for i in range(100_000)), "ab1" * 100_000, "漢" * 50_000, "\t" * 100_000, "$" * 200_000]


@pytest.fixture(scope="module")
def harsh(spark):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)


def test_tokens(harsh):
    library = Tokenizer.from_file(PATH)
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(harsh, PATH).collect()} == want
    assert {r.doc_id: r.n_tokens for r in bpe_stream.round_trip(harsh, PATH).collect()} == want


def test_personal_data(harsh):
    rows = {r.doc_id: r for r in pii.detect(harsh, pii.train(harsh)).collect()}
    assert (rows[1].n_ip, rows[2].n_ip) == (0, 1) and sum(r.n_email + r.n_card + r.n_phone for r in rows.values()) == 0
    assert pii.redact(harsh, pii.train(harsh)).count() == len(TEXTS)


def test_near_copies(harsh):
    assert simhash.near_duplicates(harsh).count() == len(TEXTS)
    # Texts without a word are equal, whatever their white space.
    assert simhash.drop_similar(harsh).count() == len(TEXTS)


def test_sketches_of_many_lines(harsh):
    rows = {r.doc_id: r for r in paragraph_sketch.fingerprints(harsh).collect()}
    assert len(rows) == len(TEXTS) and all(0 <= r.near_edited <= 1 for r in rows.values())


def test_the_rest(spark, harsh):
    assert severity.score(harsh, severity.Model.of({"a": 1.0}, [1.0, 2.0, 3.0])).count() == len(TEXTS)
    assert sharding.assign(harsh, [1.0] * 3).count() == len(TEXTS)
    assert mixing.mix(harsh, mixing.text_form(), {"source": 0.5, "lang": 0.5, "topic": 0.5}, 1.0).count() == len(TEXTS)
    assert quality.score(harsh, quality.train(harsh, harsh.select("doc_id", F.lit(1).alias("quality")))).count() == len(TEXTS)
    words = {r.word: r.n for r in spelling.vocabulary(spelling.occurrences(harsh, least=3)).collect()}
    assert words["word"] + words.get("wrd", 0) + words.get("ord", 0) + words.get("wod", 0) + words.get("wor", 0) >= 59_000
    said = harsh.select(F.col("doc_id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("assistant").alias("role"), "text")
    digests = chat_format.digests(chat_format.conversations(chat_format.log_of(said))).collect()
    assert sorted(r.loss_chars for r in digests) == sorted(map(len, TEXTS))


@pytest.mark.parametrize("name, stage", [s for s in corpus_pipeline.STAGES if s[0] != "near_duplicates"])
def test_stages(spark, harsh, name, stage):
    assert stage(spark, harsh, SF_DIR).count() > 0


def test_severity_of_the_query_equals_plain_scoring(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/{n}.parquet") for n in ("documents", "labels"))
    model = severity.train(docs, labels)
    assert model.weights and model.thresholds == sorted(model.thresholds)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in severity.score(docs, model).collect():
        found = Counter()
        for word in re.findall(r"[^\W\d_]+", texts[r.doc_id].lower()):
            found.update(f for f in {word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) >= n)} if f in model.weights)
        s = sum(model.weights[f] * math.log1p(n) for f, n in found.items())
        above = [1 / (1 + math.exp(min(t - s, 700))) for t in model.thresholds]
        assert r.p_toxic == pytest.approx(above[0], abs=1e-9) and r.expected_severity == pytest.approx(sum(above), abs=1e-9)
        assert r.grade == sum(p >= 0.5 for p in above) and r.rejected == (above[0] >= severity.REJECT)
