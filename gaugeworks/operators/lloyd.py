"""K-means for every k and restart at once.

All models take one step together: a pass over the stations adds, for every model and centre,
count, sums and cost, and the driver moves the centres.  A pass sends one row per centre and
task, whatever the number of stations; models that have settled take no more part.  Starts are
drawn on a bounded sample of the stations, each centre by squared distance to those before it.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START_ROWS = 4096
SETTLED = 1e-9


@dataclass(frozen=True)
class Centres:
    """One fitted model: its centres and the sum of squared distances to them."""

    points: np.ndarray
    cost: float
    restart: int
    steps: int

    @property
    def k(self) -> int:
        return len(self.points)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre (the first on a tie) and the squared distance to it."""
    apart = np.zeros((len(x), len(centres)))
    for axis in range(x.shape[1]):
        apart += (x[:, axis, None] - centres[None, :, axis]) ** 2
    best = apart.argmin(1)
    return best, apart[np.arange(len(x)), best]


def _points(prepared: DataFrame) -> DataFrame:
    return prepared.select(vector_to_array("features").alias("x"))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def starts(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` rows of a sample: the first by chance, each other with chance by squared distance."""
    chosen = [sample[rng.integers(len(sample))]]
    apart = ((sample - chosen[0]) ** 2).sum(1)
    while len(chosen) < k:
        total = apart.sum()
        at = rng.choice(len(sample), p=apart / total) if total > 0 else rng.integers(len(sample))
        chosen.append(sample[at])
        apart = np.minimum(apart, ((sample - chosen[-1]) ** 2).sum(1))
    return np.array(chosen)


def sample_of(prepared: DataFrame, rows: int, size: int = START_ROWS) -> np.ndarray:
    """At most about ``size`` stations, chosen by a hash of their features, in a fixed order."""
    points = _points(prepared)
    if rows > size:
        share = F.pmod(F.xxhash64("x"), F.lit(1 << 30)) / float(1 << 30)
        points = points.where(share < size / rows)
    return np.array(sorted(r["x"] for r in points.collect()))


def step(points: DataFrame, models: list[np.ndarray]) -> list[tuple[np.ndarray, float]]:
    """One pass for all models: the moved centres and the cost of the given ones."""
    width = models[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(c), np.int64) for c in models]
        sums = [np.zeros(c.shape) for c in models]
        costs = [np.zeros(len(c)) for c in models]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch.column(0), width)
            for m, centres in enumerate(models):
                best, apart = _nearest(x, centres)
                counts[m] += np.bincount(best, minlength=len(centres))
                costs[m] += np.bincount(best, apart, len(centres))
                for axis in range(width):
                    sums[m][:, axis] += np.bincount(best, x[:, axis], len(centres))
        model = np.repeat(np.arange(len(models)), [len(c) for c in models])
        centre = np.concatenate([np.arange(len(c)) for c in models])
        yield pa.RecordBatch.from_arrays(
            [pa.array(model, pa.int32()), pa.array(centre, pa.int32()), pa.array(np.concatenate(counts)),
             pa.array(np.concatenate(costs)), *[pa.array(c) for c in np.concatenate(sums).T]],
            ["model", "centre", "n", "cost", *[f"s{i}" for i in range(width)]])

    names = [f"s{i}" for i in range(width)]
    partial = points.mapInArrow(run, "model int, centre int, n long, cost double, "
                                + ", ".join(f"{s} double" for s in names))
    moved, cost = [c.copy() for c in models], [0.0] * len(models)
    totals = partial.groupBy("model", "centre").agg(*[F.sum(c).alias(c) for c in ("n", "cost", *names)])
    for r in sorted(totals.collect(), key=lambda r: (r["model"], r["centre"])):    # one row per centre
        cost[r["model"]] += r["cost"]
        if r["n"]:
            moved[r["model"]][r["centre"]] = [r[s] / r["n"] for s in names]
    return list(zip(moved, cost))


def fit_all(prepared: DataFrame, ks, restarts: int, seed: int, most_steps: int = 300) -> dict[tuple[int, int], Centres]:
    """The fitted model of every (k, restart); an empty cluster keeps its centre."""
    points = _points(prepared)
    points.persist()
    try:
        sample = sample_of(prepared, points.count())
        open_ = {(k, r): starts(sample, k, np.random.default_rng([seed, k, r])) for k in ks for r in range(restarts)}
        done: dict[tuple[int, int], Centres] = {}
        for steps in range(1, most_steps + 1):
            for (job, centres), (moved, cost) in zip(list(open_.items()), step(points, list(open_.values()))):
                if np.abs(moved - centres).max() <= SETTLED or steps == most_steps:
                    done[job] = Centres(centres, cost, job[1], steps)
                    del open_[job]
                else:
                    open_[job] = moved
            if not open_:
                break
    finally:
        points.unpersist()
    return done


def best_of(fitted: dict[tuple[int, int], Centres]) -> dict[int, Centres]:
    """For every k the restart of least cost, the earlier one on a tie."""
    best: dict[int, Centres] = {}
    for (k, _), model in sorted(fitted.items()):
        # Sums arrive in any order, so costs closer than rounding count as equal.
        if k not in best or model.cost < best[k].cost - 1e-9 * max(1.0, best[k].cost):
            best[k] = model
    return best


def label(prepared: DataFrame, models: dict[str, Centres]) -> DataFrame:
    """Add one column per model: the number of each station's nearest centre."""
    width = next(iter(models.values())).points.shape[1]
    names = [c for c in prepared.columns if c != "features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(batch.num_columns - 1), width)
            found = [pa.array(_nearest(x, m.points)[0].astype(np.int32)) for m in models.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*names, "x", *models])

    schema = T.StructType([*[prepared.schema[c] for c in names], T.StructField("x", T.ArrayType(T.DoubleType(), False)),
                           *[T.StructField(name, T.IntegerType()) for name in models]])
    return prepared.select(*names, vector_to_array("features").alias("x")).mapInArrow(run, schema)
