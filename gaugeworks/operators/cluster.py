"""Station clustering: scaling, K-means over a range of k, silhouette, choice of k.

Fitting is iterative and runs jobs; everything else stays lazy.
"""
from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators import lloyd
from gaugeworks.operators.lloyd import Centres
from gaugeworks.operators.report import relative_change
from gaugeworks.session import cut_lineage

K_RANGE = range(2, 11)
SEED = 42
RESTARTS = 10
MIN_STATIONS = 10
MAX_ITERATIONS = 300
BLOCK_ROWS, LEAST_BLOCK_ROWS, CELLS_PER_CORE = 16_384, 1024, 4
TILE_ROWS, TILE_COLUMNS = 256, 1024
# Squared distances this small against the norms are taken from differences.
NEAR = 1e-6
PART_ROWS = 8192


def complete_stations(features: DataFrame, columns: list[str]) -> DataFrame:
    """Stations with every feature; a missing coordinate is never imputed."""
    return features.na.drop(subset=columns)


def _moments(features: DataFrame, columns: list[str]):
    """Mean and population deviation of each feature as a scalar subquery."""
    spread = {c: F.stddev_pop(c) for c in columns}
    return features.agg(F.struct(*[x for c in columns for x in (
        F.avg(c).alias(f"{c}_mean"),
        F.when(spread[c] == 0, 1.0).otherwise(spread[c]).alias(f"{c}_sd"))]).alias("m")).scalar()


def scale(features: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``z_<column>``: population z-scores; a constant feature becomes zero."""
    with_moments = features.withColumn("_m", _moments(features, columns))
    return with_moments.withColumns({
        f"z_{c}": (F.col(c) - F.col(f"_m.{c}_mean")) / F.col(f"_m.{c}_sd") for c in columns
    }).drop("_m")


def spread_table(features: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation per feature, and the ratio of largest to smallest."""
    row = features.agg(*[x for c in columns for x in (
        F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_sd"))])
    sd = {c: F.when(F.col(f"{c}_sd") == 0, 1.0).otherwise(F.col(f"{c}_sd")) for c in columns}
    ratio = F.try_divide(F.greatest(*sd.values()), F.least(*sd.values()))
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}_mean").alias("mean"),
                               sd[c].alias("stddev"), ratio.alias("spread_ratio"))
                      for c in columns])
    return row.select(F.inline(cells))


def prepare(features: DataFrame, columns: list[str], min_stations: int = MIN_STATIONS,
            partitions: int | None = None) -> DataFrame:
    """Complete, scaled stations with a ``features`` vector, cut off from their lineage.

    The station table is written once to the shared folder before it is scaled
    (scaling reads it twice) and once after (K-means reads it dozens of times),
    so neither goes back to the readings.  ``partitions`` sets how many parts
    K-means reads; otherwise a table of more than :data:`PART_ROWS` stations is dealt
    into parts of so many: adaptive execution merges parts by their bytes, which are
    few, and every step would run in one task.
    """
    stations = cut_lineage(complete_stations(features, columns))
    rows = stations.count()
    if rows < min_stations:
        raise ValueError(f"fewer than {min_stations} stations with complete features")
    vectors = VectorAssembler(inputCols=[f"z_{c}" for c in columns], outputCol="features")
    scaled = vectors.transform(scale(stations, columns))
    if partitions:
        scaled = scaled.coalesce(partitions)
    elif rows > PART_ROWS:
        scaled = scaled.repartition(ceil(rows / PART_ROWS))
    return cut_lineage(scaled.drop(*[f"z_{c}" for c in columns]))


def fit(prepared: DataFrame, k: int, restarts: int = RESTARTS, seed: int = SEED) -> Centres:
    """The best of several restarts by training cost."""
    return fit_each(prepared, [k], restarts, seed)[k]


def fit_each(prepared: DataFrame, ks, restarts: int = RESTARTS, seed: int = SEED) -> dict[int, Centres]:
    """The best model for every k; all of them and their restarts take each step in one pass."""
    return lloyd.best_of(lloyd.fit_all(prepared, ks, restarts, seed, MAX_ITERATIONS))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, from differences."""
    apart = np.zeros((len(a), len(b)))
    for axis in range(a.shape[1]):
        apart += (a[:, axis, None] - b[None, :, axis]) ** 2
    return apart


def _distances(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Distances of all pairs in tiles: rows of ``a``, rows of ``b`` and their distances.

    Squares come from one matrix product about a common middle.  Where they are small against
    the norms they would have lost digits and are taken from differences, as is everything if
    a coordinate is not finite.
    """
    middle = a.mean(0)
    x, y = a - middle, b - middle
    with np.errstate(over="ignore", invalid="ignore"):
        xx, yy = (x * x).sum(1), (y * y).sum(1)
    sound = np.isfinite(xx).all() and np.isfinite(yy).all()
    left = np.column_stack([-2 * x, xx, np.ones(len(x))])
    right = np.column_stack([y, np.ones(len(y)), yy]).T
    for i in range(0, len(a), TILE_ROWS):
        for j in range(0, len(b), TILE_COLUMNS):
            rows, columns = slice(i, i + TILE_ROWS), slice(j, j + TILE_COLUMNS)
            if sound:
                apart = left[rows] @ right[:, columns]
                small = NEAR * (xx[rows].max() + yy[columns].max())
                if apart.min() <= small:
                    p, q = np.nonzero(apart <= small)
                    for at in range(0, len(p), TILE_COLUMNS):
                        few = slice(at, at + TILE_COLUMNS)
                        apart[p[few], q[few]] = ((a[rows][p[few]] - b[columns][q[few]]) ** 2).sum(1)
            else:
                apart = _apart(a[rows], b[columns])
            yield rows, columns, np.sqrt(apart, out=apart)


def _distance_sums(left: pa.Table, right: pa.Table, labels: dict[str, int]) -> pa.Table:
    """For each point of two blocks, its summed distance to the other block's points of every cluster.

    The cell of a block with itself has its points on both sides and gives each its row once.
    """
    names = [f"_s_{name}_{c}" for name, k in labels.items() for c in range(k)]
    if not left.num_rows or not right.num_rows:
        return pa.Table.from_arrays([left["_id"].slice(0, 0), *[pa.array([], pa.float64())] * len(names)], ["_id", *names])
    a, b = (np.stack([np.asarray(v, np.float64) for v in t["_x"].to_numpy()]) for t in (left, right))
    of_a, of_b = (np.concatenate([np.eye(k)[t[n].to_numpy()] for n, k in labels.items()], axis=1) for t in (left, right))
    both = left["_i"][0] != left["_j"][0]
    to_b, to_a = np.zeros((len(a), len(names))), np.zeros((len(b), len(names)))
    for rows, columns, apart in _distances(a, b):
        to_b[rows] += apart @ of_b[columns]
        if both:
            to_a[columns] += apart.T @ of_a[rows]
    ids, sums = left["_id"].combine_chunks(), to_b
    if both:
        ids, sums = pa.chunked_array([*left["_id"].chunks, *right["_id"].chunks]), np.concatenate([to_b, to_a])
    return pa.Table.from_arrays([ids, *[pa.array(c) for c in sums.T]], ["_id", *names])


def silhouette(points: DataFrame, labels: dict[str, int], vector: str = "features",
               identity: str = "station_id", measure: str = "euclidean",
               block_rows: int | None = None) -> DataFrame:
    """Mean silhouette for each labelling column (``labels`` maps it to its cluster count).

    ``euclidean`` is exact.  Points are dealt into blocks of bounded size by a
    hash of their identity (at most about ``block_rows``; without it, blocks of up
    to :data:`BLOCK_ROWS`, smaller ones where there would be too few for all cores).
    Each unordered pair of blocks is one cell; it emits for the points of both
    sides only their summed distance to each cluster, never the distances.
    All labellings share the same pass.  The work is quadratic in the number of
    points by definition; ``squaredEuclidean`` is the linear-time alternative.
    """
    spark = points.sparkSession
    if measure == "squaredEuclidean":
        scores = [(name, float(ClusteringEvaluator(
            predictionCol=name, featuresCol=vector, distanceMeasure=measure).evaluate(points)))
            for name in labels]
        return spark.createDataFrame(scores, "labelling string, silhouette double")

    is_array = points.schema[vector].dataType.typeName() == "array"
    # Values go through the shuffle as they are; they become doubles where they are used.
    x = F.col(vector) if is_array else vector_to_array(F.col(vector))
    keyed = points.select(F.col(identity).alias("_id"), x.alias("_x"),
                          *[F.col(n).cast("int").alias(n) for n in labels])
    rows = keyed.count()
    blocks = max(1, ceil(rows / (block_rows or BLOCK_ROWS)))
    if not block_rows:
        cores = spark.sparkContext.defaultParallelism
        blocks = max(blocks, min(ceil(rows / LEAST_BLOCK_ROWS), ceil((CELLS_PER_CORE * 2 * cores) ** 0.5)))
    own = F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int")
    dealt = keyed.withColumn("_own", own)
    left = dealt.select("_id", "_x", *labels, F.col("_own").alias("_i"),
                        F.explode(F.sequence(F.col("_own"), F.lit(blocks - 1))).alias("_j"))
    right = dealt.select("_id", "_x", *labels, F.explode(F.sequence(F.lit(0), F.col("_own"))).alias("_i"),
                         F.col("_own").alias("_j"))

    sums = [f"_s_{name}_{c}" for name, k in labels.items() for c in range(k)]
    per_cell = left.groupBy("_i", "_j").cogroup(right.groupBy("_i", "_j")).applyInArrow(
        lambda a, b: _distance_sums(a, b, labels),
        f"_id {keyed.schema['_id'].dataType.simpleString()}, "
        + ", ".join(f"{s} double" for s in sums))
    totals = per_cell.groupBy("_id").agg(*[F.sum(s).alias(s) for s in sums])

    sizes = keyed.agg(F.struct(*[
        F.array(*[F.count_if(F.col(n) == c) for c in range(k)]).alias(n)
        for n, k in labels.items()]).alias("sizes")).scalar()
    joined = (keyed.drop("_x").join(totals, "_id").withColumn("_sizes", sizes))
    return (joined.agg(*[F.avg(_point_silhouette(n, k)).alias(n) for n, k in labels.items()])
            .unpivot([], list(labels), "labelling", "silhouette"))


def _point_silhouette(name: str, k: int):
    """(b - a) / max(a, b) of one point from its distance sums and the cluster sizes."""
    own = F.col(name)
    size = F.col(f"_sizes.{name}")
    total = F.array(*[F.col(f"_s_{name}_{c}") for c in range(k)])
    inside = F.try_divide(F.get(total, own), F.get(size, own) - 1)
    outside = F.least(*[F.when(own != c, F.try_divide(total[c], size[c])) for c in range(k)],
                      F.lit(None).cast("double"))
    score = F.try_divide(outside - inside, F.greatest(inside, outside))
    return F.when(F.get(size, own) == 1, 0.0).otherwise(F.coalesce(score, F.lit(0.0)))


def scan_k(prepared: DataFrame, ks=K_RANGE, restarts: int = RESTARTS, seed: int = SEED,
           measure: str = "euclidean") -> tuple[DataFrame, dict[int, Centres]]:
    """(k, inertia, silhouette, measure) for every k, and the models behind it.

    ``measure`` decides what the silhouette costs: ``euclidean`` compares all pairs of
    stations, ``squaredEuclidean`` is linear in their number.
    """
    models = fit_each(prepared, ks, restarts, seed)
    labelled = lloyd.label(prepared, {f"k{k}": m for k, m in models.items()})
    scores = silhouette(labelled, {f"k{k}": k for k in models}, "x", measure=measure)
    inertia = prepared.sparkSession.createDataFrame(
        [(f"k{k}", k, m.cost) for k, m in models.items()],
        "labelling string, k int, inertia double")
    table = (inertia.join(scores, "labelling")
             .select("k", F.round("inertia", 2).alias("inertia"),
                     F.round("silhouette", 4).alias("silhouette"),
                     F.lit(measure).alias("measure")).orderBy("k"))
    return table, models


def choose_k(k_table: DataFrame, forced: int | None = None) -> DataFrame:
    """One row: the k with the best silhouette (least k on a tie) and the elbow."""
    steps = relative_change(k_table, "k", "inertia")
    chosen = (F.lit(forced) if forced is not None
              else -F.max(F.struct("silhouette", (-F.col("k")).alias("back")))["back"])
    drop = F.when(F.col("relative_change").isNotNull(),
                  F.struct("relative_change", (-F.col("k")).alias("back")))
    elbow = -F.max(drop)["back"]
    return steps.agg(chosen.cast("int").alias("chosen_k"),
                     F.coalesce(elbow, chosen).cast("int").alias("elbow_k"))


def assign(prepared: DataFrame, model: Centres, columns: list[str]) -> DataFrame:
    """Each station with its cluster, in cluster order, highest primary mean first.

    Clusters are numbered by their centres in ascending order, first feature first,
    whatever numbers the fit gave them.
    """
    order = sorted(range(model.k), key=lambda c: tuple(model.points[c]))
    number = F.array(*[F.lit(order.index(c)) for c in range(model.k)])
    return (lloyd.label(prepared, {"_fitted": model})
            .withColumn("cluster", F.get(number, F.col("_fitted")))
            .select("station_id", "state_name", "city_name", "n_hours", "cluster", *columns)
            .orderBy(F.asc("cluster"), F.desc(columns[0]), F.asc("station_id")))


def cluster_profile(assignments: DataFrame, columns: list[str]) -> DataFrame:
    """Stations, distinct cities and mean of each feature per cluster."""
    return assignments.groupBy("cluster").agg(
        F.count("*").alias("stations"), F.count_distinct("city_name").alias("cities"),
        *[F.round(F.avg(c), 2).alias(c) for c in columns])


def cluster_centres(assignments: DataFrame, x: str, y: str) -> DataFrame:
    """The centre of each cluster in two of the features."""
    return assignments.groupBy("cluster").agg(F.avg(x).alias(x), F.avg(y).alias(y))


def cluster_stations(features: DataFrame, columns: list[str], k: int | None = None, ks=K_RANGE,
                     restarts: int = RESTARTS, seed: int = SEED,
                     measure: str = "euclidean") -> dict[str, DataFrame]:
    """The whole analysis: k table, choice, assignments and cluster profile."""
    prepared = prepare(features, columns)
    table, models = scan_k(prepared, ks, restarts, seed, measure)
    table = cut_lineage(table)
    choice = choose_k(table, k)
    picked = choice.first()["chosen_k"]
    model = models[picked] if picked in models else fit(prepared, picked, restarts, seed)
    assignments = assign(prepared, model, columns)
    return {"k_table": table, "choice": choice, "assignments": assignments,
            "profile": cluster_profile(assignments, columns)}
