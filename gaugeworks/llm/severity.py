"""Toxicity as a severity grade by cumulative-link ordinal regression.

P(grade > k) = logistic(w.x - t_k): all thresholds t_0 < t_1 < ... share the weights w, so
grades keep their order.  Features are words and their first four, five and six letters
(inflected forms share those), each as log(1 + occurrences).  The expected severity is the
sum of P(grade > k); a document is rejected when P(grade > 0) reaches :data:`REJECT`.

Labels only say toxic or not.  Grades are derived: 0 for not toxic; toxic documents are cut
in three by how many of their words carry a feature that marks toxicity.

Fitting uses at most about :data:`SAMPLE` labelled documents, chosen by hash of the key, and
the :data:`VOCABULARY` features whose document frequency differs most between the classes; both are collected as
counts only.  Scoring reads whole texts of all documents.

Null texts are empty and score as such; a null label is no label, repeated labels of a
document count as their largest; repeated rows are scored each; without toxic labels every
document gets severity 0; an empty table gives an empty result.  Texts of any length are read
whole, in pieces.  Other columns are left out by :func:`score` and kept as they are by
:func:`keep_clean`, whatever their names.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import hash_sample, mapped, pieces, slices, text_or_empty, typed

SAMPLE = 8000
VOCABULARY = 1024
LEAST_DOCUMENTS = 4
LEAST_LOG_ODDS = 1.5
# Likelihood ratio that chance reaches once in about a million features.
LEAST_RATIO = 24.0
GRADES = 4
REJECT = 0.5
PIECE_CHARS = 1 << 18

_WORD = re.compile(r"[^\W\d_]+")
_STEMS = (4, 5, 6)


def words(text: str) -> Iterator[list[str]]:
    for piece in pieces(text, PIECE_CHARS):
        yield _WORD.findall(piece.lower())


def features(word: str) -> Iterable[str]:
    """The word itself, and its beginnings with a mark that no word holds."""
    yield word
    for n in _STEMS:
        if len(word) >= n:
            yield word[:n] + "*"


@dataclass
class Model:
    """Weights by feature, rising thresholds, and the beginnings of words that can have a feature."""

    weights: dict[str, float]
    thresholds: list[float]
    starts: frozenset[str]

    @classmethod
    def of(cls, weights: dict[str, float], thresholds: list[float]) -> Model:
        return cls(weights, thresholds, frozenset(f.rstrip("*")[:_STEMS[0]] for f in weights))

    def known(self, text: str) -> Iterator[list[str]]:
        """For every word with known features, these features."""
        starts, first = self.starts, _STEMS[0]
        for part in words(text):
            for word in [w for w in part if w[:first] in starts]:
                if found := [f for f in features(word) if f in self.weights]:
                    yield found

    def counts(self, text: str) -> Counter[str]:
        return Counter(f for found in self.known(text) for f in found)

    def hits(self, text: str) -> int:
        return sum(1 for _ in self.known(text))

    def above(self, text: str) -> list[float]:
        """P(grade > k) for k = 0, 1, ..."""
        score = sum(self.weights[f] * math.log1p(n) for f, n in sorted(self.counts(text).items()))
        return [1 / (1 + math.exp(min(t - score, 700))) for t in self.thresholds]


def _contrast(sample: DataFrame) -> list[tuple[str, float]]:
    """Features whose document frequency differs most between toxic and other documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for batch in slices(batches, 0):
            for text, toxic in zip(batch.column(0), batch.column(1)):
                seen[toxic.as_py()].update(
                    {f for part in words(text.as_py()) for w in set(part) for f in features(w)})
            names = list({*seen[0], *seen[1]})
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[0][n] for n in names], pa.int64()),
                 pa.array([seen[1][n] for n in names], pa.int64())], ["feature", "clean", "toxic"])
            seen = (Counter(), Counter())

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return []
    counted = (mapped(sample.select("text", "toxic"), run, "feature string, clean long, toxic long")
               .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
               .where(F.col("clean") + F.col("toxic") >= LEAST_DOCUMENTS))
    odds = (F.log((F.col("toxic") + 0.5) / (sizes[1] + 1.0))
            - F.log((F.col("clean") + 0.5) / (sizes[0] + 1.0)))
    share = (F.col("toxic") + F.col("clean")) / (sizes[0] + sizes[1])

    def part(seen, size, expected):
        """One cell's part of the likelihood ratio; an empty cell adds nothing."""
        return F.when(seen > 0, seen * F.log(seen / (size * expected))).otherwise(0.0)

    ratio = 2 * sum((part(seen, size, share) + part(size - seen, size, 1 - share)
                     for seen, size in ((F.col("toxic"), sizes[1]), (F.col("clean"), sizes[0]))), F.lit(0.0))
    best = (counted.where(share < 1).withColumn("odds", odds).withColumn("ratio", ratio)
            .where((F.abs("odds") >= LEAST_LOG_ODDS) & (F.col("ratio") >= LEAST_RATIO))
            .orderBy(F.desc("ratio"), "feature").limit(VOCABULARY))
    return [(r["feature"], r["odds"]) for r in best.collect()]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit to a bounded sample of the labelled documents."""
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
             .groupBy(key).agg(F.max((F.col(label) > 0).cast("int")).alias("toxic")))
    # The sample holds about ``sample`` rows of two numbers, so it may be broadcast.
    chosen = F.broadcast(hash_sample(known, key, sample, "severity"))
    both = docs.select(F.col(key), text_or_empty(text).alias("text")).join(chosen, key)
    vocabulary = _contrast(both)
    if not vocabulary:
        return Model.of({}, [40.0] * (GRADES - 1))
    index = {f: i for i, (f, _) in enumerate(vocabulary)}
    probe = Model.of({f: odds for f, odds in vocabulary}, [])
    marked = Model.of({f: odds for f, odds in vocabulary if odds > 0}, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            rows = []
            for value in batch.column(0):
                text = value.as_py()
                found = probe.counts(text)
                rows.append(([v for f, n in sorted(found.items()) for v in (index[f], n)],
                             marked.hits(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[1] for r in rows], pa.int64()), batch.column(1)], ["found", "hits", "toxic"])

    rows = (mapped(both.select("text", "toxic"), run, "found array<long>, hits long, toxic int")
            .groupBy("found", "hits", "toxic").count().collect())
    rows = sorted((r["toxic"], r["hits"], r["found"], r["count"]) for r in rows)
    weight = np.array([r[3] for r in rows], float)
    toxic = np.array([r[0] for r in rows])
    hits = np.array([r[1] for r in rows])
    cuts = np.quantile(np.repeat(hits[toxic == 1], weight[toxic == 1].astype(int)),
                       np.arange(1, GRADES - 1) / (GRADES - 1))
    grade = np.where(toxic == 1, 1 + np.searchsorted(cuts, hits, side="right"), 0)
    at = np.repeat(np.arange(len(rows)), [len(r[2]) // 2 for r in rows])
    flat = np.array([v for r in rows for v in r[2]], np.int64).reshape(-1, 2)
    w, t = fit(at, flat[:, 0], np.log1p(flat[:, 1]), grade, weight, len(vocabulary), GRADES)
    return Model.of({f: float(w[i]) for f, i in index.items()}, [float(x) for x in t])


def fit(row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray,
        weight: np.ndarray, columns: int, grades: int, steps: int = 800, rate: float = 0.05,
        ridge: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of greatest penalised likelihood, from sparse (row, column, value)."""
    weight = weight / weight.sum()
    w = np.zeros(columns)
    # Thresholds as the first one and logarithms of the gaps keep their order.
    free = np.r_[1.0, np.zeros(grades - 2)]
    moments = [np.zeros(columns + grades - 1), np.zeros(columns + grades - 1)]
    for step in range(1, steps + 1):
        t = np.cumsum(np.r_[free[0], np.exp(free[1:])])
        score = np.bincount(row, w[column] * value, len(grade))
        below = 1 / (1 + np.exp(np.clip(score[:, None] - t[None, :], -500, 500)))
        below = np.c_[np.zeros(len(grade)), below, np.ones(len(grade))]
        low, high = (np.take_along_axis(below, grade[:, None] + k, axis=1)[:, 0] for k in (0, 1))
        chance = np.maximum(high - low, 1e-12)
        slope_score = weight * (1 - high - low)                  # of the negative log-likelihood
        slope_t = np.zeros(grades - 1)
        for k in range(grades - 1):
            bend = below[:, k + 1] * (1 - below[:, k + 1])
            slope_t[k] = np.sum(weight * bend / chance * (1.0 * (grade == k + 1) - (grade == k)))
        tail = np.cumsum(slope_t[::-1])[::-1]
        slope = np.r_[np.bincount(column, slope_score[row] * value, columns) + ridge * w,
                      tail[0], tail[1:] * np.exp(free[1:])]
        moments[0] += 0.1 * (slope - moments[0])
        moments[1] += 0.01 * (slope * slope - moments[1])
        move = rate * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.99 ** step)) + 1e-9)
        w, free = w - move[:columns], free - move[columns:]
    return w, np.cumsum(np.r_[free[0], np.exp(free[1:])])


def _scored(texts: Iterable[str], model: Model) -> tuple[list[float], list[float], list[int]]:
    above = [model.above(t) for t in texts]
    return ([a[0] for a in above], [sum(a) for a in above], [sum(x >= 0.5 for x in a) for a in above])


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``p_toxic``, ``expected_severity``, ``grade`` (the median grade), ``rejected``."""
    names = [key, "p_toxic", "expected_severity", "grade"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            p, expected, grade = _scored(batch.column(1).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p, pa.float64()), pa.array(expected, pa.float64()),
                 pa.array(grade, pa.int32())], names)

    kinds = [T.DoubleType(), T.DoubleType(), T.IntegerType()]
    scored = mapped(docs.select(F.col(key), text_or_empty(text).alias("text")), run, T.StructType(
        [typed(docs, key), *(T.StructField(n, k) for n, k in zip(names[1:], kinds))]))
    return scored.withColumn("rejected", F.col("p_toxic") >= REJECT)


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows that are not rejected, with all their columns."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place):
            p, _, _ = _scored((t or "" for t in batch.column(place).to_pylist()), model)
            yield batch.filter(pa.array([x < REJECT for x in p], pa.bool_()))

    return mapped(docs, run, docs.schema)
