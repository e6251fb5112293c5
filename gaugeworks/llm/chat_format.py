"""Chat formatting from an event log.

The log has one row per event: conversation, sequence number, turn, kind, role, text.
``delta`` appends its text to the turn, ``edit`` replaces the text of the turn, and
``regenerate`` empties it; an edit or regeneration also drops all later turns that
were written before it.  Conversations are partitioned by their key, events sorted by
sequence number and folded into final messages, and messages are rendered:

    system     <<SYS>>text<</SYS>>
    user       [INST]text[/INST]
    assistant  text</s>
    others     <|role|>name<|text|>text<|end|>

Inside texts and names a backslash is doubled and a control string gets a backslash
after its first character, so no text holds a control string and parsing is exact.
The loss mask covers the escaped texts of assistants, as half-open character spans.

Deltas of a turn are joined per (conversation, turn), so a task only holds whole
conversations as final messages, which the rendered string needs in one row anyway.

Nulls: a null text is empty, a null role the empty role, null conversation keys form
one conversation, null turns and sequence numbers come first, a null kind is a delta.
Events with equal sequence numbers are folded by kind, role and text.  Repeated rows
are events of their own.  An empty log gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import mapped, typed

CONTROL = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "</s>", "<|role|>", "<|text|>", "<|end|>")
_NEEDS_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"(.)\\|\\\\", re.DOTALL)
_MARK = re.compile("|".join(map(re.escape, CONTROL)))
_FOLDED = T.ArrayType(T.StructType([T.StructField("turn", T.LongType()),
                                    T.StructField("role", T.StringType()),
                                    T.StructField("text", T.StringType())]))


def escape(text: str) -> str:
    return _NEEDS_ESCAPE.sub(
        lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    r"""Undo :func:`escape`: ``\\`` is a backslash, a lone backslash after a character goes."""
    out, at = [], 0
    while (slash := text.find("\\", at)) >= 0:
        out.append(text[at:slash])
        if text.startswith("\\\\", slash):
            out.append("\\")
            at = slash + 2
        else:
            at = slash + 1
    out.append(text[at:])
    return "".join(out)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted conversation and the spans of its loss mask."""
    out, spans, size = [], [], 0
    for role, text in turns:
        body = escape(text)
        before, after = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"),
                         "assistant": ("", "</s>")}.get(
                             role, (f"<|role|>{escape(role)}<|text|>", "<|end|>"))
        if role == "assistant":
            spans.append((size, size + len(body)))
        out += [before, body, after]
        size += len(before) + len(body) + len(after)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from a formatted conversation."""
    turns, at, role = [], 0, "assistant"
    for mark in _MARK.finditer(formatted):
        inside = formatted[at:mark.start()]
        at = mark.end()
        match mark[0]:
            case "<<SYS>>":
                role = "system"
            case "[INST]":
                role = "user"
            case "<|text|>":
                role = unescape(inside)
            case "<|role|>":
                role = ""
            case _:
                turns.append((role, unescape(inside)))
                role = "assistant"
    return turns


def fold(log: DataFrame, key: str = "conv_id") -> DataFrame:
    """Final messages of an event log: ``key``, ``turn``, ``role``, ``text``.

    A turn lives if no edit or regeneration of an earlier turn came after its last
    reset; its text is that reset's text with all later deltas joined in order.
    """
    order = F.struct(F.col("seq"), "kind", "role", "text")
    events = log.select(
        F.col(key), F.col("turn").cast("long").alias("turn"), F.col("seq").cast("long").alias("seq"),
        F.coalesce("kind", F.lit("delta")).alias("kind"), F.coalesce("role", F.lit("")).alias("role"),
        F.when(F.col("kind") == "regenerate", "").otherwise(F.coalesce("text", F.lit(""))).alias("text"))
    resets = F.col("kind").isin("edit", "regenerate")
    per_turn = events.groupBy(key, "turn").agg(
        F.max(F.when(resets, F.col("seq"))).alias("reset"),
        F.sort_array(F.collect_list(order)).alias("events"))
    # Truncation from earlier turns: the latest reset among turns before this one.
    before = (Window.partitionBy(key).orderBy("turn")
              .rowsBetween(Window.unboundedPreceding, -1))
    cut = F.max("reset").over(before)
    kept = F.expr("""
        filter(events, (e, i) -> cut IS NULL OR e.seq > cut)""")
    base = F.expr("""
        array_max(transform(events, (e, i) -> IF(e.kind IN ('edit', 'regenerate'), i, -1)))""")
    return (per_turn.withColumn("cut", cut)
            .withColumn("events", kept).where(F.size("events") > 0)
            .withColumn("base", base)
            .withColumn("events", F.expr("slice(events, greatest(base, 0) + 1, size(events))"))
            .select(key, "turn", F.col("events")[0]["role"].alias("role"),
                    F.expr("array_join(transform(events, e -> e.text), '')").alias("text")))


def log_of(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """A table of whole messages as a log: one delta per message, in the order of turns.

    Rows that repeat a turn stay messages of their own, in the order of role and text.
    """
    place = Window.partitionBy(key).orderBy("turn", "role", "text")
    return conversations.select(
        F.col(key), (F.row_number().over(place) - 1).cast("long").alias("turn"),
        (F.row_number().over(place) - 1).cast("long").alias("seq"),
        F.lit("delta").alias("kind"), "role", "text")


def conversations(log: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key``, ``formatted``, ``loss_spans`` (array of start, end) per conversation."""
    messages = (fold(log, key).groupBy(key)
                .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("messages")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            done = [render([(m["role"], m["text"]) for m in v.as_py()]) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([d[0] for d in done], pa.string()),
                 pa.array([[{"start": a, "end": b} for a, b in d[1]] for d in done], kind)],
                [key, "formatted", "loss_spans"])

    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                      T.StructField("end", T.LongType())]))
    return mapped(messages, run, T.StructType([
        typed(log, key), T.StructField("formatted", T.StringType()),
        T.StructField("loss_spans", spans)]))


def digests(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """What can be read back from formatted conversations, as counts and hashes."""
    names = [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = parse(text)
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                rows.append((len(turns),
                             hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                             len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    kinds = [T.LongType(), T.StringType(), T.LongType(), T.StringType(), T.LongType()]
    return mapped(formatted.select(key, "formatted", "loss_spans"), run, T.StructType(
        [typed(formatted, key), *(T.StructField(n, k) for n, k in zip(names[1:], kinds))]))
