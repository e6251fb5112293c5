"""Token counts of whole texts without keeping tokens.

Texts are encoded in batches inside an Arrow function that returns lengths only.
A text is first cut into units, a run of white space and the word after it; a
byte-level pattern always starts a new word between a non-space and a plain space
or line feed, so the counts of the units add up to the count of the text.  Units
already counted by this worker are looked up; the rest go to the tokenizer in
batches of about equal bytes.  Only units of up to :data:`UNIT_CHARS` characters are
remembered, :data:`REMEMBERED` of them, so that memory has a bound in bytes.  A worker holds
one piece of a text and one batch besides; a text without a plain space or line feed
after a non-space has no certain boundary and is one piece.

Nulls count as empty texts (0 bytes, 0 tokens); repeated rows are counted each; an
empty table gives an empty result; other columns of the input are ignored.
"""
from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import mapped, pieces, slices, text_or_empty, typed

PIECE_CHARS = 1 << 19
BATCH_BYTES = 1 << 18
REMEMBERED = 300_000
UNIT_CHARS = 64

# White space, then a word; odd white space after it is not a certain boundary.
_UNIT = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")


def by_bytes(units: Iterable[str], limit: int) -> Iterator[list[str]]:
    """Units in lists of about ``limit`` bytes; a longer unit stands alone."""
    held, size = [], 0
    for unit in units:
        width = 4 * len(unit) if not unit.isascii() else len(unit)
        if held and size + width > limit:
            yield held
            held, size = [], 0
        held.append(unit)
        size += width
    if held:
        yield held


class Counter:
    """Counts tokens with one tokenizer file and remembers the units it has seen."""

    def __init__(self, path: str, batch_bytes: int = BATCH_BYTES, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.batch_bytes, self.remembered, self.known = batch_bytes, remembered, {}

    def learn(self, units: list[str]) -> None:
        new = {u for u in units if u not in self.known}
        if len(self.known) + len(new) > self.remembered:
            self.known.clear()
            new = set(units)
        for batch in by_bytes(new, self.batch_bytes):
            encoded = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
            self.known.update(zip(batch, map(len, encoded)))

    def counted(self, units: list[str]) -> int:
        """Tokens of units that are not worth remembering."""
        return sum(len(e) for batch in by_bytes(units, self.batch_bytes)
                   for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False))

    def counts(self, texts: Iterable[str]) -> list[int]:
        """One count per text; units of short texts are learned together."""
        totals: list[int] = []
        waiting: list[tuple[int, list[str]]] = []
        size = 0

        def settle() -> None:
            self.learn([u for _, units in waiting for u in units if len(u) <= UNIT_CHARS])
            for at, units in waiting:
                long = [u for u in units if len(u) > UNIT_CHARS]
                totals[at] += sum(self.known[u] for u in units if len(u) <= UNIT_CHARS) + self.counted(long)
            waiting.clear()

        for text in texts:
            totals.append(0)
            for piece in pieces(text, PIECE_CHARS):
                waiting.append((len(totals) - 1, _UNIT.findall(piece)))
                size += len(piece)
                if size > PIECE_CHARS:
                    settle()
                    size = 0
        settle()
        return totals


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One per worker process, so that what it remembers serves later tasks, too."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Bytes and tokens of every text: ``key``, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``tokenizer`` is the path of a byte-level tokenizer file that exists on every executor.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            texts = (value.as_py() for value in batch.column(1))
            totals = counter(tokenizer).counts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(totals, pa.int64())],
                [key, "n_bytes", "n_tokens"])

    schema = T.StructType([typed(docs, key), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])
    counted = mapped(docs.select(
        F.col(key), text_or_empty(text).alias("text"),
        F.octet_length(text_or_empty(text)).cast("long").alias("n_bytes")), count, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
