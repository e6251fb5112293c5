"""Batches of text that executors and Python workers hold at once are bounded by bytes, not by rows."""
from __future__ import annotations

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import bpe_stream, common, pii, severity, simhash, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = severity.Model.of({"bad": 9.0}, [1.0, 2.0, 3.0])


@pytest.fixture
def unset(spark):
    spark.conf.unset(common.BATCH_SETTING)
    yield spark
    spark.conf.unset(common.BATCH_SETTING)


def test_batches_are_bounded_by_bytes(unset):
    docs = unset.range(0, 6000, 1, 1).select("id", F.repeat(F.lit("ab "), 700).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    seen = common.mapped(docs, sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in seen) == 6000
    assert max(r["bytes"] for r in seen) < 1.1 * common.SLICE_BYTES          # one batch of 12 MB before


@pytest.mark.parametrize("stage", [
    lambda docs: severity.keep_clean(docs, MODEL),
    lambda docs: severity.score(docs, MODEL),
    lambda docs: simhash.fingerprints(docs, 3),
    lambda docs: simhash.shingle_sets(docs, 5, "doc_id", "text"),
    lambda docs: simhash.drop_similar(docs),
    lambda docs: pii.redact(docs, pii.train(docs)),
    lambda docs: bpe_stream.encode(docs, PATH),
    lambda docs: bpe_stream.round_trip(docs, PATH),
    lambda docs: token_counts.token_counts(docs, PATH, limit=1024),
], ids=["keep_clean", "score", "fingerprints", "shingle_sets", "drop_similar", "redact", "encode", "round_trip", "token_counts"])
def test_operators_ask_for_bounded_batches(unset, stage):
    docs = unset.createDataFrame([(1, "one two three four five six"), (2, None)], "doc_id long, text string")
    assert stage(docs).count() == 2
    assert unset.conf.get(common.BATCH_SETTING) == str(common.SLICE_BYTES)
