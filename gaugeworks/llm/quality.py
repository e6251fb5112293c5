"""Quality of documents by gradient-boosted trees over statistics of their texts.

A text becomes :data:`FEATURES`, all from its whole length: shares of letter cases, digits,
marks and blanks, lengths of words and lines, repetition of words, word pairs, triples and
lines, entropy of bytes.  Key, language, source and labels are no features.

Trees are grown on histograms: each feature is cut at quantiles of the training rows into at
most :data:`BINS` bins, every level adds first and second derivatives of the logistic loss per
node, feature and bin, and takes the best cut.  Finished trees are flattened into arrays
(complete trees, node i has children 2i + 1 and 2i + 2; a node that is not cut sends all to
the left), and a batch goes down all trees at once, one numpy step per level.

Fitting uses about :data:`SAMPLE` labelled documents at most, chosen by hash of the key; only
their statistics and labels reach the driver.  Scoring reads whole texts of all documents.

Null and empty texts have statistics of zero and a score; a null label or key is no label;
of repeated labels the smallest counts; repeated rows are scored each.  Without labels of both
kinds every score is the same (0.99 or 0.01 for the one kind, 0.5 for none).  An empty table gives an empty
result.  Other columns are left out.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import hash_sample, mapped, slices, text_or_empty, typed

SAMPLE = 8000
BINS = 32
TREES = 80
DEPTH = 4
RATE = 0.2
LEAST_WEIGHT = 1.0
RIDGE = 1.0

_MARKS = ".,;:!?|#$%&*+-_=/<>()[]{}\"'@~^`\\"
_GROUPS = {
    "upper": range(ord("A"), ord("Z") + 1), "lower": range(ord("a"), ord("z") + 1),
    "digit": range(ord("0"), ord("9") + 1), "blank": [9, 11, 12, 13, 32], "line_feed": [10],
    "high": range(0x80, 0x100), "control": [c for c in range(32) if not 9 <= c <= 13],
    "stop": map(ord, ".?"), "comma": map(ord, ",;:"), "shout": map(ord, "!"), "bar": map(ord, "|"),
    "symbol": map(ord, "#$%&*@~^"), "bracket": map(ord, "<>()[]{}"), "mark": map(ord, _MARKS)}
_IN_GROUP = np.zeros((256, len(_GROUPS)))
for _i, _codes in enumerate(_GROUPS.values()):
    _IN_GROUP[list(_codes), _i] = 1
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_IS_MARK = np.isin(np.arange(256), [ord(c) for c in _MARKS])
_IS_UPPER = np.isin(np.arange(256), list(range(65, 91)))
_IS_LOWER = np.isin(np.arange(256), list(range(97, 123)))
# Random 64-bit factors for hashing runs of bytes: one per byte value, one per place.
_BY_VALUE, _BY_PLACE = np.random.default_rng(1).integers(0, 1 << 63, (2, 256), np.uint64) | np.uint64(1)

FEATURES = [*_GROUPS, "log_bytes", "entropy", "log_words", "word_mean", "word_spread", "word_longest", "long_words",
            "short_words", "marked_words", "capital_words", "shouted_words", "distinct_words", "top_word",
            "repeated_pairs", "repeated_triples", "next_same", "log_lines", "line_mean", "line_spread",
            "repeated_lines", "top_line"]


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs of true values."""
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit number per run of bytes; equal runs have equal numbers."""
    length = end - begin
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    values = _BY_VALUE[codes[np.repeat(begin, length) + place]] * _BY_PLACE[place % 256]
    return np.add.reduceat(values ^ (values >> np.uint64(29)), np.cumsum(length) - length) + length.astype(np.uint64)


def _repeated(hashes: np.ndarray) -> tuple[float, float]:
    """Share of runs that are not the first of their kind, and of the most frequent kind."""
    if not len(hashes):
        return 0.0, 0.0
    _, counts = np.unique(hashes, return_counts=True)
    return 1 - len(counts) / len(hashes), counts.max() / len(hashes)


def statistics(text: str) -> np.ndarray:
    """The features of one whole text, in the order of :data:`FEATURES`."""
    codes = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(codes):
        return np.zeros(len(FEATURES))
    counts = np.bincount(codes, minlength=256)
    share = counts / len(codes)
    out = [*(share @ _IN_GROUP), np.log1p(len(codes)), -(share[share > 0] * np.log2(share[share > 0])).sum()]

    begin, end = _runs(~_SPACE[codes])
    if len(begin):
        length = end - begin
        word = _hashes(codes, begin, end)
        pair = word[1:] * np.uint64(31) + word[:-1]
        triple = pair[1:] * np.uint64(31) + word[:-2]
        first, last = codes[begin], codes[end - 1]
        # Words without a lower-case letter and with some letter: capitals throughout.
        lower = np.add.reduceat(np.r_[_IS_LOWER[codes], False].astype(int), begin)
        upper = np.add.reduceat(np.r_[_IS_UPPER[codes], False].astype(int), begin)
        repeated, top = _repeated(word)
        out += [np.log1p(len(word)), length.mean(), length.std(), np.log1p(length.max()), (length > 15).mean(),
                (length < 3).mean(), _IS_MARK[last].mean(), _IS_UPPER[first].mean(),
                ((lower == 0) & (upper > 1)).mean(), 1 - repeated, top, _repeated(pair)[0], _repeated(triple)[0],
                (word[1:] == word[:-1]).mean() if len(word) > 1 else 0.0]
    else:
        out += [0.0] * 14
    begin, end = _runs(codes != 10)
    if len(begin):
        length = end - begin
        out += [np.log1p(len(begin)), np.log1p(length.mean()), np.log1p(length.std()),
                *_repeated(_hashes(codes, begin, end))]
    else:
        out += [0.0] * 5
    return np.array(out)


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: trees x inner nodes, and trees x leaves."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sum over the trees for each row, all trees at once, one step per level."""
        trees, inner = self.feature.shape
        if not trees:
            return np.full(len(x), self.base)
        tree, row = np.arange(trees)[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), trees), np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.cut[tree, node])
        return self.base + self.leaf[tree, node - inner].sum(1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The chance of label 1."""
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
        rate: float = RATE) -> Trees:
    """Boosted trees on binned features under logistic loss."""
    rows, columns = x.shape
    inner = (1 << depth) - 1
    share = y.mean() if rows else 0.5
    if not rows or not 0 < share < 1:
        flat = np.zeros((0, inner))
        return Trees(float(np.log(0.99 / 0.01) * (2 * share - 1)), flat.astype(int), flat, np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(c, np.arange(1, bins) / bins, method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    cell = np.arange(columns) * bins + binned
    base = float(np.log(share / (1 - share)))
    margin = np.full(rows, base)
    feature, cut = np.zeros((trees, inner), int), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(rows, int)
        for level in range(depth):
            nodes = 1 << level
            at = (node[:, None] * (columns * bins) + cell).ravel()
            shape = (nodes, columns, bins)
            g, h = (np.bincount(at, np.repeat(v, columns), nodes * columns * bins).reshape(shape) for v in (slope, bend))
            left_g, left_h = g.cumsum(2), h.cumsum(2)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = (left_g ** 2 / (left_h + RIDGE) + right_g ** 2 / (right_h + RIDGE) - all_g ** 2 / (all_h + RIDGE))
            gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            useful = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-6
            by, bin_ = best // bins, best % bins
            for n in np.flatnonzero(useful):
                feature[t, nodes - 1 + n], cut[t, nodes - 1 + n] = by[n], edges[by[n]][bin_[n]]
            node = 2 * node + (useful[node] & (binned[np.arange(rows), by[node]] > bin_[node]))
        g, h = (np.bincount(node, v, inner + 1) for v in (slope, bend))
        leaf[t] = rate * g / (h + RIDGE)
        margin += leaf[t][node]
    return Trees(base, feature, cut, leaf)


def held_out(key: Column) -> Column:
    """Rows whose labels are kept for judging: checksum of the key modulo 3 is 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", sample: int = SAMPLE) -> Trees:
    """Fit to a bounded sample of the labelled documents that are not held out."""
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
             .groupBy(key).agg(F.min((F.col(label) > 0).cast("int")).alias("_label")))
    # About ``sample`` rows of two numbers, so it may be broadcast.
    chosen = F.broadcast(hash_sample(known, key, sample, "quality"))
    both = docs.select(F.col(key), text_or_empty(text).alias("_text")).join(chosen, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            found = [statistics(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)],
                                             ["x", "y"])

    # Rows are sorted, so that the sums of the fit do not depend on the order of arrival.
    rows = sorted((tuple(r["x"]), r["y"]) for r in
                  mapped(both.select("_text", "_label"), run, "x array<double>, y int").collect())
    x = np.array([r[0] for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r[1] for r in rows], float))


def score(docs: DataFrame, model: Trees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = [statistics(t.as_py()) for t in batch.column(1)]
            x = np.array(found).reshape(len(found), len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], [key, "score"])

    scored = mapped(docs.select(F.col(key), text_or_empty(text).alias("_text")),
        run, T.StructType([typed(docs, key), T.StructField("score", T.DoubleType())]))
    return scored.select(key, held_out(F.col(key)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
