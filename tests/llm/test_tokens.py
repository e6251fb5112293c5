"""Token counts and the streaming transducer against the tokenizer library."""
from __future__ import annotations

import hashlib
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gaugeworks.llm import bpe_stream, queries, token_counts
from tests.conftest import SF_DIR
from tests.llm.conftest import ROWS

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
MACHINE = bpe_stream.Transducer(PATH)
COUNTER = token_counts.Counter(PATH, batch_bytes=64, remembered=50)
PARTS = st.sampled_from(["a", "the", "ing", " ", "  ", "\n", "\t", " ", "é", "²", "½", "<|endoftext|>", "12",
                         "!", "...", "'s", "'re", "’", "漢", "\U0001F600", "\x1c", "\x85", "​", "_", "\r\n",
                         "́", "اب", "١", "ﬁ", "Ǆ"])


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.lists(PARTS, max_size=40).map("".join), st.text(max_size=60)))
def test_any_text_as_the_library(text):
    text = text.encode("utf-8", "replace").decode()
    ids = ids_of(text)
    assert MACHINE.encode(text) == ids
    assert "".join(MACHINE.decode(ids)) == LIBRARY.decode(ids, skip_special_tokens=False)
    assert COUNTER.counts([text]) == [len(ids)]


@pytest.mark.parametrize("text", ["a" * 3000, "=" * 2000, "ab" * 900, "etaoinshrdlu" * 150, "lo" * 700 + "x"])
def test_words_longer_than_the_window(text):
    assert len(text) > MACHINE.window + MACHINE.lookahead
    assert MACHINE.encode(text) == ids_of(text)


def test_lookahead_follows_the_merge_list():
    # c could be taken by (c, d), and d by (d, e): two more bytes decide whether (b, c) happens.
    merges = [(3, 4, 10), (2, 3, 11), (1, 2, 12)]
    assert bpe_stream.sufficient_lookahead(merges, dict.fromkeys(range(5), 1) | {10: 2, 11: 2, 12: 2}) >= 2
    assert 0 < MACHINE.lookahead < 1000


def test_unfinished_bytes_become_replacement_characters():
    ids = MACHINE.encode("漢")
    assert len(ids) > 1
    assert "".join(MACHINE.decode(ids[:-1])) == LIBRARY.decode(ids[:-1], skip_special_tokens=False)
    assert "".join(MACHINE.decode([])) == ""


def test_long_text_is_cut_at_safe_boundaries():
    text = " ".join(f"word{i}\n\n x" for i in range(20_000))
    counter = token_counts.Counter(PATH)
    assert counter.counts([text, "x"]) == [len(ids_of(text)), 1]


def test_edge_rows(odd, none):
    rows = token_counts.token_counts(odd, PATH, limit=3).collect()
    want = sorted((r[0] or 0, len((r[1] or "").encode()), len(ids_of(r[1] or ""))) for r in ROWS)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 3) for r in rows)
    assert token_counts.token_counts(none, PATH).count() == 0
    back = bpe_stream.decode(bpe_stream.encode(odd, PATH), PATH).collect()
    assert sorted(r.text for r in back) == sorted(r[1] or "" for r in ROWS)
    assert bpe_stream.encode(none, PATH).count() == bpe_stream.round_trip(none, PATH).count() == 0


def test_queries_cover_all_documents(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    counted = {r.doc_id: r.n_tokens for r in queries.op1_token_counts(spark, SF_DIR).collect()}
    tripped = {r.doc_id: r for r in queries.op8_bpe_round_trip(spark, SF_DIR).collect()}
    assert counted.keys() == tripped.keys() == texts.keys()
    for key, text in texts.items():
        ids = ids_of(text)
        assert counted[key] == tripped[key].n_tokens == len(ids)
        assert tripped[key].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert tripped[key].decoded_sha256 == hashlib.sha256(
            LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_what_is_remembered_has_a_bound_in_bytes():
    counter = token_counts.Counter(PATH, remembered=100)
    texts = ["word\tand\tmore\t" * 20_000, "x" * 1_000_000, " ".join(f"{i:x}" * 40 for i in range(500)), "0123456789" * 500,
             *(f"a{i} b{i} c{i}" for i in range(200))]
    counter_of = [len(ids_of(t)) for t in texts]
    assert counter.counts(texts) == counter_of
    assert all(len(unit) <= token_counts.UNIT_CHARS for unit in counter.known)
    assert counter.counts([f"a{i}" for i in range(90)]) == [len(ids_of(f"a{i}")) for i in range(90)]
    assert len(counter.known) <= 100
