"""Event folding, rendering and reading back."""
from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeworks.llm import chat_format, queries
from tests.conftest import SF_DIR

LOG = "conv_id long, seq long, turn long, kind string, role string, text string"
PIECES = st.sampled_from([*chat_format.CONTROL, "\\", "<", "[", "|", "ok", " ", "\n", "é", "INST]", "s>"])
TEXT = st.lists(PIECES, max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT), TEXT), max_size=6))
def test_read_back_what_was_written(turns):
    text, spans = chat_format.render(turns)
    assert chat_format.parse(text) == turns
    assert [chat_format.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    for _, body in turns:
        assert not any(c in chat_format.escape(body) for c in chat_format.CONTROL)


def folded(spark, events):
    rows = chat_format.fold(spark.createDataFrame(events, LOG)).collect()
    return sorted((r.conv_id or 0, r.turn, r.role, r.text) for r in rows)


def test_deltas_edits_and_regenerations(spark):
    events = [
        (1, 2, 1, "delta", "assistant", "lo"), (1, 1, 1, "delta", "assistant", "hel"),
        (1, 0, 0, "delta", "user", "hi"),
        (1, 3, 1, "regenerate", "assistant", None), (1, 4, 1, "delta", "assistant", "bye"),
        (2, 0, 0, "delta", "user", "old"), (2, 1, 1, "delta", "assistant", "to be dropped"),
        (2, 2, 0, "edit", "user", "new"), (2, 3, 1, "delta", "assistant", "fresh"),
        (None, None, None, None, None, None),
    ]
    assert folded(spark, events) == [
        (0, None, "", ""), (1, 0, "user", "hi"), (1, 1, "assistant", "bye"),
        (2, 0, "user", "new"), (2, 1, "assistant", "fresh")]
    again = folded(spark, events[::-1])
    assert again == folded(spark, events)


def test_empty_log(spark):
    log = spark.createDataFrame([], LOG)
    assert chat_format.digests(chat_format.conversations(log)).count() == 0


def test_query_against_brute_force(spark):
    rows = sorted((r.conv_id, r.turn, r.role, r.text or "")
                  for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect())
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    want = {}
    for conv, _, role, text in rows:
        want.setdefault(conv, []).append((role, text))
    got = {r.conv_id: r for r in queries.op10_chat_format(spark, SF_DIR).collect()}
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (
            len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv].formatted_chars == len(chat_format.render(turns)[0])


def test_repeated_turns_stay_messages(spark):
    said = spark.createDataFrame([(1, 0, "user", "a", "x"), (1, 0, "user", "a", "x"), (1, None, None, None, None)],
                                 "conv_id long, turn long, role string, text string, seq string")
    row = chat_format.digests(chat_format.conversations(chat_format.log_of(said))).first()
    assert row.n_turns == 3
