"""Exact top-k by inner product with MaxScore over shards of integer vectors.

A shard keeps its vectors as postings: per term (component) the rows that have it and their
values.  A query's terms are its non-zero components, a term's bound in a shard is the largest
product any of its vectors can add.  Terms are put in order of their bounds; those whose bounds
add up to less than what a vector must reach (the query's goal) are non-essential: a vector
that has no other terms cannot enter.  The postings of the essential terms are traversed, term
by term; a vector stays a candidate only while its score so far plus the bounds of the terms
not looked at reaches the goal, and only candidates are probed for the non-essential terms,
from the largest bound down.  Rows are taken in runs, and the goal rises with every run.
Shards are merged by score, ties go to the smaller id.

The first goal of a query is its k-th score among a pilot of :data:`PILOT_ROWS` vectors, which
is never above its k-th score among all, so it decides work and no result; all shards start
from it.  Queries and vectors are dealt into blocks of bounded expected size, and a task holds
one block of each, so neither side is ever whole in one place.

Vectors that are null or hold null or non-finite components, and rows with a null id, take
no part; shorter vectors count as ending in zeros.  A query never returns its own id;
repeated rows are candidates each; query rows with one id are one query (its smallest
vector).  Scores are exact while they fit in 63 bits.  Empty input gives an empty result;
other columns are left out.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import staged

SHARD_ROWS = 8192
QUERY_ROWS = 1024
RUN = 2048
PROBE = 8
FULL = 0.25
PILOT_ROWS = 2048
_BEST = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                      T.StructField("score", T.LongType())])


def integers(vectors: DataFrame, scale: int = 64, key: str = "vec_id",
             vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``, every component x as floor(scale * x); unusable rows are left out."""
    usable = F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(usable).select(
        F.col(key).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(scale * x.cast("double")).cast("long")).alias("v"))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims), np.int64)
    for i, row in enumerate(column.to_pylist()):
        out[i, :len(row)] = row
    return out


class Postings:
    """The non-zero components of some rows, by term.

    A list is its rows in order and their values; one that holds more than :data:`FULL` of the
    rows is kept as values of all rows, which is smaller and quicker to go through.
    """

    def __init__(self, rows: np.ndarray):
        by_term = np.ascontiguousarray(rows.T)
        self.size = np.count_nonzero(by_term, axis=1)
        self.is_full = self.size > FULL * len(rows)
        self.place = np.where(self.is_full, np.cumsum(self.is_full), np.cumsum(~self.is_full)) - 1
        self.full = by_term[self.is_full]
        term, self.row = np.nonzero(by_term[~self.is_full])
        self.value = by_term[~self.is_full][term, self.row]
        self.end = np.cumsum(self.size[~self.is_full])

    def traverse(self, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The scores of all rows on some terms, from their lists."""
        is_full = self.is_full[terms]
        score = weight[terms[is_full]] @ self.full[self.place[terms[is_full]]]
        for t in terms[~is_full]:
            end = self.end[self.place[t]]
            cut = slice(end - self.size[t], end)
            score[self.row[cut]] += weight[t] * self.value[cut]
        return score


def candidates(part: np.ndarray, postings: Postings, weight: np.ndarray, bound: np.ndarray,
               goal: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows that reach the goal, their scores, and how many products that took.

    ``weight`` and ``bound`` are of the query's terms, one number per component.
    """
    terms = np.flatnonzero(weight)
    terms = terms[np.argsort(bound[terms], kind="stable")]
    sums = np.cumsum(bound[terms])
    # Rising bounds; a vector with non-essential terms only stays below the goal.
    optional = int(np.searchsorted(sums, goal, side="left"))
    score = postings.traverse(terms[optional:], weight)
    products = int(postings.size[terms[optional:]].sum())
    rows = np.flatnonzero(score >= goal - sums[optional - 1]) if optional else np.flatnonzero(score >= goal)
    score = score[rows]
    while optional and len(rows):
        # The largest bounds first, some terms at a time.
        start = max(0, optional - PROBE)
        some = terms[start:optional]
        score = score + part[rows[:, None], some] @ weight[some]
        products += len(rows) * len(some)
        optional = start
        alive = score >= (goal - sums[start - 1] if start else goal)
        rows, score = rows[alive], score[alive]
    return rows, score, products


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
           run: int = RUN, goals: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Best k of one shard for one block of queries: query positions, ids, scores; and the products taken.

    ``goals`` are scores that a result must reach, -inf where there is none.
    """
    n_queries, dims = queries.shape
    goals = [-math.inf] * n_queries if goals is None else goals.tolist()
    # Sums of whole numbers are exact in floating point up to 2**24 or 2**53; beyond that integers are used.
    widest = np.abs(queries.astype(float)).max(initial=0) * np.abs(vectors.astype(float)).max(initial=0)
    largest = 2 * max(widest * max(dims, 1), max((abs(g) for g in goals if g != -math.inf), default=0))
    kind = np.float32 if largest < 2 ** 24 else np.float64 if largest < 2 ** 53 else np.int64
    vectors, queries = vectors.astype(kind), queries.astype(kind)
    best = [(np.zeros(0, kind), np.zeros(0, np.int64))] * n_queries
    low, high = vectors.min(axis=0, initial=0), vectors.max(axis=0, initial=0)
    bounds = np.maximum(queries * low, queries * high)         # at least 0: a term may be absent
    work = 0
    for at in range(0, len(vectors), run):
        part, names = vectors[at:at + run], ids[at:at + run]
        postings = Postings(part)
        for q in range(n_queries):
            rows, score, products = candidates(part, postings, queries[q], bounds[q], goals[q])
            work += products
            other = names[rows] != query_ids[q]
            score = np.r_[best[q][0], score[other]]
            name = np.r_[best[q][1], names[rows[other]]]
            first = np.lexsort((name, -score))[:k]
            best[q] = score[first], name[first]
            if len(first) == k:
                goals[q] = max(goals[q], score[first[-1]])
    sizes = [len(s) for s, _ in best]
    scores, found = (np.concatenate([b[i] for b in best]) if best else np.zeros(0) for i in (0, 1))
    return np.repeat(np.arange(n_queries), sizes), found.astype(np.int64), scores.astype(np.int64), work


def _blocks(rows: DataFrame, by: Column, number: str, *columns: str) -> DataFrame:
    return rows.groupBy(by.alias(number)).agg(F.collect_list(F.struct(*columns)).alias("rows"))


def _searched(vectors: DataFrame, asked: DataFrame, shards: int, parts: int, k: int) -> DataFrame:
    """The best k of every shard for every query: each block of one side meets each of the other."""
    each = lambda number, n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(number)
    left = _blocks(vectors, F.pmod(F.xxhash64("salt"), F.lit(shards)).cast("int"), "shard", "vec_id", "v"
                   ).select("shard", each("part", parts), "rows")
    right = _blocks(asked, F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"), "part", "vec_id", "v", "goal"
                    ).select("part", each("shard", shards), "rows")

    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        none = pa.Table.from_arrays([pa.array([], pa.int64())] * 3, _BEST.names)
        if not one.num_rows or not two.num_rows:
            return none
        a, b = (t.column("rows").combine_chunks().flatten() for t in (one, two))
        rows = [(x.field("vec_id"), x.field("v")) for x in (a, b)]
        dims = max((len(v) for _, vs in rows for v in vs), default=0)
        (ids, these), (names, those) = ((i.to_numpy(zero_copy_only=False), _matrix(v, dims)) for i, v in rows)
        goals = np.array([-math.inf if g is None else g for g in b.field("goal").to_pylist()], object)
        q, i, s, _ = search(ids, these, names, those, k, goals=goals)
        return pa.Table.from_arrays([pa.array(names[q]), pa.array(i), pa.array(s)], _BEST.names)

    return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(run, _BEST)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS,
          query_rows: int = QUERY_ROWS, pilot_rows: int = PILOT_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best vectors of every query.

    Both frames hold ``vec_id`` and ``v`` as :func:`integers` gives them.
    """
    vectors = staged(vectors.withColumn("salt", F.monotonically_increasing_id()), "vectors")
    asked = staged(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    rows = vectors.count()
    shards = max(1, math.ceil(rows / shard_rows))
    parts = max(1, math.ceil(asked.count() / query_rows))
    goals = asked.withColumn("goal", F.lit(None).cast("long"))
    if shards > 1:
        share = min(1.0, pilot_rows / rows)
        pilot = vectors.where(F.pmod(F.xxhash64(F.lit("pilot"), "salt"), F.lit(1 << 30)) < int(share * (1 << 30)))
        reached = _searched(pilot, goals, 1, parts, k).groupBy("query_id").agg(
            F.min("score").alias("goal"), F.count("*").alias("n")).where(F.col("n") >= k)
        goals = staged(asked.join(reached, F.col("vec_id") == F.col("query_id"), "left")
                       .select("vec_id", "v", "goal"), "query-goals")
    partial = _searched(vectors, goals, shards, parts, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
