"""Personal data in texts: fixed patterns, extended by a skip-chain conditional random field.

Patterns find the base spans (:func:`base_spans`), which always stay.  The field labels
tokens that hold a digit or ``@``; its features are counts, shape and the word before, its
chain edges join neighbouring tokens, and its skip edges join distant tokens of a document
that are equal or end in the same seven digits.  Both ends of an edge share a potential, so a
token that no pattern accepts is labelled with the entity it repeats elsewhere.  Tokens inside
base spans are observed.  Loopy belief propagation runs over all documents of a batch at once;
equal tokens are joined one occurrence to the next, and each to the first observed one, so
edges grow with tokens, not pairs, and evidence reaches every repeat.  Messages are passed until
none changes; only tokens that got new ones send again.
A label other than "none" is used from :data:`CERTAIN` on, and only on a token that skip edges
lead back to one that a pattern found, or that follows such a token in the chain: shape alone
adds nothing.  Ends of added spans are trimmed to characters an entity of the kind can have.

Weights are fitted by pseudo-likelihood to the base labels of a bounded sample of documents
(:data:`SAMPLE` rows, chosen by hash of the key; of their tokens, equal ones merged, at most
:data:`TRAINING_ROWS`, chosen by hash).  A token without a base label that repeats
one with a label is not counted as "none" there, but left out: it is what the field is for.

Null texts are empty and have no spans; null keys are kept; repeated rows get the same spans;
an empty table gives an empty result and an empty sample a field that adds nothing.  Texts and
tokens of any length are read whole; columns besides key and text are left out by
:func:`detect` and kept as they are by :func:`redact`, whatever their names.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import hash_sample, mapped, slices, text_or_empty, typed

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = NONE + 1
SAMPLE = 4000
TRAINING_ROWS = 100_000
CERTAIN = 0.8
# Messages that change by less are not sent on.  Without loops they settle undamped; where they
# have not by UNDAMPED rounds, steps are halved, and from DAMPED rounds on they shrink.
SETTLED = 1e-4
UNDAMPED, DAMPED = 100, 1000
# Without evidence against it, both ends of a skip edge tend to one label.
AGREEMENT = 8.0
BUCKETS = 512
SLOTS = 9

Span = tuple[int, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_SEED = re.compile(r"[0-9@]+")
_SPACE = re.compile(r"\s")
_EDGE = ".,;:!?()[]{}<>\"'|"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _is_byte(digits: str) -> bool:
    """Whether digits without leading zeros, of any number, are at most 255."""
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from each ``@``, so that a long run of letters is looked at once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind and start; ends are exclusive, positions are code points."""
    spans = [(0, a, b) for a, b in _emails(text)]
    if "." in text:
        spans += [(1, *m.span()) for m in _IP.finditer(text)
                  if all(_is_byte(p.lstrip("0")) for p in m[0].split("."))]
    for kind, pattern in ((2, _CARD), (3, _PHONE)):
        for m in pattern.finditer(text):
            if m.end() - m.start() < 8:
                continue
            digits = _NOT_DIGIT.sub("", m[0])
            if (16 <= len(digits) <= 19 and luhn(digits)) if kind == 2 else 8 <= len(digits) <= 15:
                spans.append((kind, *m.span()))
    return spans


@dataclass
class Nodes:
    """Tokens of one or more documents as arrays for the field."""

    spans: list[tuple[int, int]] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    observed: list[int] = field(default_factory=list)          # a label, or -1
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)


def _tokens(text: str) -> Iterator[tuple[int, int, str]]:
    """Tokens with a digit or ``@``: start, end and the word before."""
    done = 0
    for seed in _SEED.finditer(text):
        if seed.start() < done:
            continue
        start = seed.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        found = _SPACE.search(text, seed.end())
        done = end = found.start() if found else len(text)
        word = text[max(0, start - 24):start].split()
        yield start, end, word[-1].strip(_EDGE).lower() if word else ""


def _shape(token: str) -> str:
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", token))


def add_document(nodes: Nodes, text: str, spans: list[Span]) -> None:
    """Append the tokens of a text, their features and their edges."""
    first, last_end = len(nodes.spans), -2
    repeats: dict[str, list[int]] = {}
    ordered = sorted((a, b, k) for k, a, b in spans)
    at = 0
    for start, end, before in _tokens(text):
        raw = text[start:end]
        token = raw.strip(_EDGE)
        lead = len(raw) - len(raw.lstrip(_EDGE))
        begin, stop = start + lead, start + lead + len(token)
        if not token:
            continue
        while at < len(ordered) and ordered[at][1] <= begin:
            at += 1
        label = ordered[at][2] if at < len(ordered) and ordered[at][0] < stop else -1
        digits = _NOT_DIGIT.sub("", token)
        named = [f"digits:{min(len(digits), 20)}", f"shape:{_shape(token)}", f"before:{before}",
                 f"at:{token.count('@')}", f"dots:{min(token.count('.'), 4)}", f"lead:{token[0] in '+('}",
                 f"mixed:{token.isdigit()}", f"size:{len(token) // 4}",
                 f"checks:{16 <= len(digits) <= 19 and luhn(digits)}"]
        here = len(nodes.spans)
        nodes.spans.append((begin, stop))
        nodes.features.append([crc32(n.encode()) % BUCKETS for n in named])
        nodes.observed.append(label)
        if here > first and start - last_end == 1:
            nodes.chain.append((here - 1, here))
        last_end = end
        for alike in {*([token.lower()] if len(token) >= 4 else []), *([digits[-7:]] if len(digits) >= 7 else [])}:
            repeats.setdefault(alike, []).append(here)
    edges = {}
    for places in repeats.values():
        edges |= dict.fromkeys(zip(places, places[1:]))
        if (known := next((p for p in places if nodes.observed[p] >= 0), None)) is not None:
            edges |= dict.fromkeys((min(known, p), max(known, p)) for p in places if p != known)
    nodes.skip += sorted(edges)


@dataclass
class Model:
    """Weights of the field: features x labels, and label x label for both kinds of edges."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @classmethod
    def empty(cls) -> Model:
        return cls(np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))


def marginals(model: Model, nodes: Nodes) -> np.ndarray:
    """Label probabilities of all tokens by loopy message passing."""
    n = len(nodes.spans)
    unary = model.unary[np.array(nodes.features).reshape(n, -1)].sum(axis=1)
    observed = np.array(nodes.observed, np.int64)
    known = observed >= 0
    unary[known] = -50.0
    unary[known, observed[known]] = 0.0
    edges = np.array(nodes.chain + nodes.skip, np.int64).reshape(-1, 2)
    potential = np.concatenate([np.broadcast_to(model.chain, (len(nodes.chain), LABELS, LABELS)),
                                np.broadcast_to(model.skip, (len(nodes.skip), LABELS, LABELS))])
    source, target = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
    potential = np.concatenate([potential, potential])
    back = np.r_[np.arange(len(edges)) + len(edges), np.arange(len(edges))]
    message = np.zeros((len(source), LABELS))
    total = unary.copy()
    order = np.argsort(source, kind="stable")
    ends = np.cumsum(np.bincount(source, minlength=n))
    starts = ends - np.bincount(source, minlength=n)
    active, rounds = np.arange(len(source)), 0
    while len(active) and rounds < DAMPED + 4 * n:
        rounds += 1
        sent = (total[source[active]] - message[back[active]])[:, :, None] + potential[active]
        top = sent.max(axis=1, keepdims=True)
        new = np.log(np.exp(sent - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        change = new - message[active]
        moved = np.abs(change).max(axis=1) >= SETTLED
        active, change = active[moved], change[moved]
        if rounds > UNDAMPED:
            change = change * 0.5 * min(1.0, DAMPED / rounds)
        message[active] += change
        np.add.at(total, target[active], change)
        # Who got a new message sends again, and a damped one is not yet where it goes.
        told = np.unique(np.concatenate([target[active], source[active]]) if rounds > UNDAMPED else target[active])
        counts = ends[told] - starts[told]
        active = order[np.repeat(starts[told] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
    total = np.exp(total - total.max(axis=1, keepdims=True))
    return total / total.sum(axis=1, keepdims=True)


def supported(label: np.ndarray, sure: np.ndarray, nodes: Nodes) -> np.ndarray:
    """Sure tokens that repeat an entity a pattern found, and their chain neighbours of one label."""
    observed = np.array(nodes.observed, np.int64)
    kind = np.where(observed >= 0, observed, label)
    joined: dict[int, list[int]] = {}
    for chain, edges in ((False, nodes.skip), (True, nodes.chain)):
        for a, b in edges:
            # A pattern's own span is whole, so its neighbours in the text gain nothing from it.
            if kind[a] == kind[b] and not (chain and (observed[a] >= 0 or observed[b] >= 0)):
                joined.setdefault(a, []).append(b)
                joined.setdefault(b, []).append(a)
    reached = np.zeros(len(kind), bool)
    waiting = [i for i in joined if observed[i] >= 0]
    while waiting:
        for j in joined[waiting.pop()]:
            if sure[j] and not reached[j]:
                reached[j] = True
                waiting.append(j)
    return reached


def _trimmed(text: str, kind: int, start: int, end: int) -> tuple[int, int]:
    """Ends moved inwards to characters an entity of the kind can begin and end with."""
    def fits(c: str, extra: str) -> bool:
        return c.isascii() and (c.isdigit() or kind == 0 and c.isalpha() or c in extra)

    while start < end and not fits(text[start], "._%+-" if kind == 0 else "+" if kind == 3 else ""):
        start += 1
    while start < end and not fits(text[end - 1], "-" if kind == 0 else ""):
        end -= 1
    return start, end


def find_spans(texts: list[str], model: Model) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    nodes, bases, ends = Nodes(), [], []
    for text in texts:
        bases.append(base_spans(text))
        add_document(nodes, text, bases[-1])
        ends.append(len(nodes.spans))
    if not nodes.spans:
        return [(base, []) for base in bases]
    chance = marginals(model, nodes)
    label = chance.argmax(axis=1)
    sure = (chance.max(axis=1) >= CERTAIN) & (label != NONE) & (np.array(nodes.observed) < 0)
    sure = supported(label, sure, nodes)
    joined = set(nodes.chain)
    out, start = [], 0
    for text, base, end in zip(texts, bases, ends):
        added: list[Span] = []
        for i in np.nonzero(sure[start:end])[0] + start:
            kind, (a, b) = int(label[i]), nodes.spans[i]
            if added and added[-1][0] == kind and (i - 1, i) in joined and sure[i - 1]:
                added[-1] = (kind, added[-1][1], b)
            else:
                added.append((kind, a, b))
        trimmed = [(kind, *_trimmed(text, kind, a, b)) for kind, a, b in added]
        out.append((base, [span for span in trimmed if span[1] < span[2]]))
        start = end
    return out


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """Fit the field to the base labels of a bounded sample of documents."""
    width = SLOTS + 1 + 2 * LABELS

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            nodes = Nodes()
            for value in batch.column(0):
                add_document(nodes, value.as_py(), base_spans(value.as_py()))
            labels = [k if k >= 0 else NONE for k in nodes.observed]
            unsure = {x for edge in nodes.skip for x, y in (edge, edge[::-1])
                      if labels[x] == NONE != labels[y]}
            near = np.zeros((len(labels), 2, LABELS), np.int64)
            for which, edges in enumerate((nodes.chain, nodes.skip)):
                for a, b in edges:
                    if not unsure & {a, b}:
                        near[a, which, labels[b]] += 1
                        near[b, which, labels[a]] += 1
            data = np.concatenate([np.array(nodes.features, np.int64).reshape(-1, SLOTS),
                                   np.array(labels, np.int64).reshape(-1, 1),
                                   near.reshape(-1, 2 * LABELS)], axis=1)
            data = np.delete(data, sorted(unsure), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(list(data), pa.list_(pa.int64()))], ["row"])

    some = hash_sample(docs.select(F.col(key), text_or_empty(text).alias("text")), key, sample, "pii")
    found = (mapped(some.select("text"), rows, "row array<long>")
             .groupBy("row").count().orderBy(F.xxhash64("row")).limit(TRAINING_ROWS).toPandas())
    if not len(found):
        return Model.empty()
    data = np.array([list(r) for r in found["row"]], np.int64).reshape(-1, width)
    order = np.lexsort(data.T[::-1])
    return fit(data[order], found["count"].to_numpy(float)[order])


def fit(data: np.ndarray, weight: np.ndarray, steps: int = 400, rate: float = 0.1,
        ridge: float = 1e-4) -> Model:
    """Pseudo-likelihood: each token's label given its features and its neighbours' labels."""
    features, label = data[:, :SLOTS], data[:, SLOTS]
    near = data[:, SLOTS + 1:].reshape(-1, 2, LABELS).astype(float)
    weight = weight / weight.sum()
    prior = [np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), AGREEMENT * np.eye(LABELS)]
    params = [p.copy() for p in prior]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    truth = np.eye(LABELS)[label]
    for step in range(1, steps + 1):
        score = params[0][features].sum(axis=1) + near[:, 0] @ params[1] + near[:, 1] @ params[2]
        chance = np.exp(score - score.max(axis=1, keepdims=True))
        error = (chance / chance.sum(axis=1, keepdims=True) - truth) * weight[:, None]
        slopes = [np.stack([np.bincount(features.ravel(), np.repeat(error[:, k], SLOTS), BUCKETS)
                            for k in range(LABELS)], axis=1)]
        slopes += [(s + s.T) / 2 for s in (near[:, 0].T @ error, near[:, 1].T @ error)]
        for p, s, start, (m, v) in zip(params, slopes, prior, moments):
            s = s + ridge * (p - start)
            m += 0.1 * (s - m)
            v += 0.01 * (s * s - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    return Model(*params)


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def detect(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, base counts ``n_<kind>``, ``base_sha256``, ``spans`` (all) and ``n_added``."""
    names = [key, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = find_spans(batch.column(1).to_pylist(), model)
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64())
                      for k in range(NONE)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts,
                 pa.array([hashlib.sha256(_listed(b).encode()).hexdigest() for b, _ in found], pa.string()),
                 pa.array([_listed(b + more) for b, more in found], pa.string()),
                 pa.array([len(more) for _, more in found], pa.int64())], names)

    kinds = [T.LongType()] * NONE + [T.StringType(), T.StringType(), T.LongType()]
    return mapped(docs.select(F.col(key), text_or_empty(text).alias("text")), run, T.StructType(
        [typed(docs, key), *(T.StructField(n, k) for n, k in zip(names[1:], kinds))]))


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The same rows with every span replaced by ``<KIND>``; overlapping spans become one.

    A null text stays null.  All columns are kept as they are.
    """
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place):
            texts = batch.column(place).to_pylist()
            found = find_spans([t or "" for t in texts], model)
            clean = [t if t is None else _replace(t, base + more) for t, (base, more) in zip(texts, found)]
            columns = list(batch.columns)
            columns[place] = pa.array(clean, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return mapped(docs, run, docs.schema)


def _replace(text: str, spans: list[Span]) -> str:
    out, done = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= done:
            out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    out.append(text[done:])
    return "".join(out)
