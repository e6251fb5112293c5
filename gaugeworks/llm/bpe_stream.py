"""Byte-pair encoding and decoding as a streaming transducer with bounded lookahead.

The merge list tells how many bytes beyond a token can still change it (``lookahead``):
a merge can only be forestalled from the right by a merge of lower rank that takes its
right part, and that one by a still lower one, so the chain ends and its longest total
length is computed once from the list.  A word is read through a window; tokens that end
at least that many bytes before the end of the window are stable and are emitted, the
window moves to the first token that is not, and memory stays constant however long the
word is.  Decoding feeds the bytes of the tokens to a byte-to-text state machine that
keeps at most the head of one unfinished character between steps.

Nulls are empty texts (no ids); special strings in a text become their ids, as the
tokenizer file defines them.  Repeated rows are encoded each; an empty table gives an
empty result; other columns of the input are ignored.
"""
from __future__ import annotations

import codecs
import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import mapped, pieces, slices, text_or_empty, typed

PIECE_CHARS = 1 << 18
WINDOW_BYTES = 256
REMEMBERED = 200_000
REMEMBERED_CHARS = 64
DECODE_TOKENS = 1 << 14

# Fixed value: the word pattern of this tokenizer family.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# The same words by the faster standard module, right for characters outside _UNUSUAL.
_PLAIN_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_UNUSUAL = re.compile(r"[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-ɀ‐-‧]")


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 byte values: themselves where printable, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in set(shown))
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def sufficient_lookahead(merges: list[tuple[int, int, int]], width: dict[int, int]) -> int:
    """Bytes after a token that can still change it; merges as (left, right, result) by rank.

    ``need[t]``: bytes right of t that decide whether t forms.  t = (x, y) fails from the
    right only if y does not form or an earlier merge (y, z) takes it; ``taken[y]`` counts z
    and the bytes that decide in the same way whether that merge happens.  One pass in rank
    order sees every earlier merge.
    """
    need: dict[int, int] = {}
    taken: dict[int, int] = {}
    for left, right, made in merges:
        decides = max(need.get(right, 0), taken.get(right, 0))
        need[made] = max(need.get(made, 0), decides)
        taken[left] = max(taken.get(left, 0), width[right] + decides)
    ends = {t: max(need.get(t, 0), taken.get(t, 0)) for t in width}
    return max(ends.values(), default=0)


class Transducer:
    """Encoder and decoder for one byte-level BPE file."""

    def __init__(self, path: str, window: int = WINDOW_BYTES, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("not a byte-level BPE file")
        alphabet, vocab = byte_alphabet(), spec["model"]["vocab"]
        self.bytes_of = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items()}
        self.start = [0] * 256
        for token, i in vocab.items():
            if len(token) == 1:
                self.start[alphabet[token]] = i
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        merges = []
        for entry in spec["model"]["merges"]:
            left, right = entry.split(" ") if isinstance(entry, str) else entry
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self.rank[a, b] = len(self.made)
            self.made.append(c)
            merges.append((a, b, c))
        self.lookahead = sufficient_lookahead(merges, {i: len(b) for i, b in self.bytes_of.items()})
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: text.encode() for text, i in self.special.items()}
        self.split = re.compile("(" + "|".join(
            sorted(map(re.escape, self.special), key=len, reverse=True)) + ")") if self.special else None
        self.window = max(window, *map(len, self.bytes_of.values()))
        self.remembered, self.known = remembered, {}

    def merge(self, data: bytes) -> list[int]:
        """Apply the merge list to one stretch of bytes."""
        ids = [self.start[b] for b in data]
        rank, none = self.rank.get, len(self.made)
        ranks = [rank(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (lowest := min(ranks)) < none:
            at = ranks.index(lowest)
            made = ids[at] = self.made[lowest]
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank((made, ids[at + 1]), none)
            if at:
                ranks[at - 1] = rank((ids[at - 1], made), none)
        return ids

    def word(self, data: bytes) -> Iterator[int]:
        """Ids of one word, each emitted as soon as no later byte can change it."""
        at, reach = 0, self.window + self.lookahead
        while len(data) - at > reach:
            stable = at + self.window
            ids = self.merge(data[at:at + reach])
            for i in ids:
                if at + len(self.bytes_of[i]) > stable:
                    break
                yield i
                at += len(self.bytes_of[i])
        yield from self.merge(data[at:])

    def packed_word(self, word: str) -> bytes:
        data = word.encode()
        ids = self.merge(data) if len(data) <= self.window else list(self.word(data))
        return struct.pack(f"<{len(ids)}I", *ids)

    def packed(self, text: str) -> Iterator[bytes]:
        """Ids of a text as little-endian unsigned 32-bit integers, piece by piece."""
        for part in (self.split.split(text) if self.split else [text]):
            if part in self.special:
                yield struct.pack("<I", self.special[part])
                continue
            for piece in pieces(part, PIECE_CHARS):
                pattern = WORDS if _UNUSUAL.search(piece) else _PLAIN_WORDS
                words = pattern.findall(piece)
                yield self._pack(words)

    def _pack(self, words: list[str]) -> bytes:
        known = self.known
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            new = {w for w in words if w not in known}
        if len(known) + len(new) > self.remembered:
            known.clear()
            new = set(words)
        known.update((w, self.packed_word(w)) for w in new if len(w) <= REMEMBERED_CHARS)
        return b"".join([known[w] if w in known else self.packed_word(w) for w in words])

    def encode(self, text: str) -> list[int]:
        data = b"".join(self.packed(text))
        return list(struct.unpack(f"<{len(data) // 4}I", data))

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of the ids as it becomes certain; bytes that form no character become U+FFFD."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        held: list[bytes] = []
        for i in ids:
            held.append(self.bytes_of[i])
            if len(held) >= DECODE_TOKENS:
                yield state.decode(b"".join(held))
                held = []
        yield state.decode(b"".join(held), final=True)

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids and of the text decoded from them."""
        ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
        state = codecs.getincrementaldecoder("utf-8")("replace")
        table = self.bytes_of
        for part in self.packed(text):
            ids_hash.update(part)
            n += len(part) // 4
            data = b"".join(map(table.__getitem__, memoryview(part).cast("I")))
            text_hash.update(state.decode(data).encode())
        text_hash.update(state.decode(b"", final=True).encode())
        return n, ids_hash.hexdigest(), text_hash.hexdigest()


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    """One per worker process and file."""
    return Transducer(path)


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` (binary, little-endian unsigned 32-bit) and ``exact``.

    ``exact`` says that the ids decode to the text again.
    """
    names = [key, "n_tokens", "ids", "exact"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for batch in slices(batches, 1):
            texts = batch.column(1).to_pylist()
            ids = [b"".join(machine.packed(t)) for t in texts]
            exact = ["".join(machine.decode(memoryview(i).cast("I"))) == t for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(exact, pa.bool_())], names)

    kinds = [T.LongType(), T.BinaryType(), T.BooleanType()]
    return mapped(docs.select(F.col(key), text_or_empty(text).alias("text")), run, T.StructType(
        [typed(docs, key), *(T.StructField(n, k) for n, k in zip(names[1:], kinds))]))


def decode(encoded: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``text`` of ids as :func:`encode` packs them; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            texts = ["".join(transducer(tokenizer).decode(memoryview(v.as_py() or b"").cast("I")))
                     for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    return mapped(encoded.select(F.col(key), F.col(ids).alias("ids")),
        run, T.StructType([typed(encoded, key), T.StructField("text", T.StringType())]))


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``: each text encoded and decoded again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows = [transducer(tokenizer).round_trip(v.as_py()) for v in batch.column(1)]
            n, ids, decoded = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                 pa.array(decoded, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return mapped(docs.select(F.col(key), text_or_empty(text).alias("text")),
        run, T.StructType([typed(docs, key), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())]))
