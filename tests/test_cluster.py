"""Clustering on planted groups and a brute-force silhouette."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import checks, cluster, lloyd
from gaugeworks.plans.catalog import QUERIES
from gaugeworks.plans.tables import LINES, Tables
from tests.conftest import SF_DIR

COLUMNS = ["a_avg", "b_avg", "c_avg"]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    points = np.vstack([rng.normal(0, 1, (20, 3)), rng.normal(30, 1, (20, 3))])
    rows = [(f"s{i}", "S", f"C{i % 5}", 900, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "station_id string, state_name string, city_name string, "
                                 "n_hours int, " + ", ".join(f"{c} double" for c in COLUMNS))


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i, own in enumerate(labels):
        same = (labels == own)
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][same].sum() / (same.sum() - 1)
        b = min(d[i][labels == other].mean() for other in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_silhouette_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    x, labels = rng.normal(0, 1, (60, 4)), rng.integers(0, 3, 60)
    labels[labels == 2] = 1
    labels[0] = 2  # a cluster of one
    other = rng.integers(0, 2, 60)
    rows = [(i, [float(v) for v in p], int(l), int(o))
            for i, (p, l, o) in enumerate(zip(x, labels, other))]
    points = spark.createDataFrame(rows, "i int, x array<double>, first int, second int")
    out = {r.labelling: r.silhouette for r in cluster.silhouette(
        points, {"first": 3, "second": 2}, "x", "i", block_rows=block_rows).collect()}
    assert out["first"] == pytest.approx(brute_silhouette(x, labels), abs=1e-9)
    assert out["second"] == pytest.approx(brute_silhouette(x, other), abs=1e-9)


def test_two_planted_groups_are_found(spark, blobs):
    result = cluster.cluster_stations(blobs, COLUMNS, ks=range(2, 5), restarts=3)
    table = result["k_table"].orderBy("k").collect()
    assert [r.k for r in table] == [2, 3, 4] and table[0].silhouette > 0.9
    inertia = [r.inertia for r in table]
    assert inertia == sorted(inertia, reverse=True)
    assert result["choice"].first()["chosen_k"] == 2
    assert sorted(r.stations for r in result["profile"].collect()) == [20, 20]
    order = [(r.cluster, -r.a_avg) for r in result["assignments"].collect()]
    assert order == sorted(order)
    cover = checks.cluster_coverage(result["assignments"], blobs).first()
    assert cover.covered and cover.clusters == 2
    forced = cluster.cluster_stations(blobs, COLUMNS, k=5, ks=range(2, 4), restarts=1)
    assert forced["profile"].count() == 5


def test_squared_measure_is_named_and_close_to_one(spark, blobs):
    prepared = cluster.prepare(blobs, COLUMNS)
    labelled = lloyd.label(prepared, {"k2": cluster.fit(prepared, 2, restarts=1)})
    row = cluster.silhouette(labelled, {"k2": 2}, "x", measure="squaredEuclidean").first()
    assert row.silhouette > 0.95


def test_inertia_is_on_population_scores(spark, blobs):
    x = np.array([[r[c] for c in COLUMNS] for r in blobs.collect()])
    z = (x - x.mean(0)) / x.std(0)
    model = cluster.fit(cluster.prepare(blobs, COLUMNS), 2, restarts=2)
    half = [z[:20], z[20:]]
    expected = sum(((h - h.mean(0)) ** 2).sum() for h in half)
    assert model.cost == pytest.approx(expected, rel=1e-9)


def test_constant_feature_scales_to_zero(spark, blobs):
    flat = blobs.withColumn("c_avg", F.lit(4.0))
    z = [r.z_c_avg for r in cluster.scale(flat, COLUMNS).collect()]
    assert set(z) == {0.0}
    spread = {r.feature: r for r in cluster.spread_table(flat, COLUMNS).collect()}
    assert spread["c_avg"].stddev == 1.0 and spread["a_avg"].spread_ratio > 10


def test_too_few_stations_are_refused(spark, blobs):
    with pytest.raises(ValueError):
        cluster.prepare(blobs.limit(9), COLUMNS)


def test_published_k_table_gives_the_published_choice(spark):
    inertia = [1990.24, 1637.04, 1419.16, 1262.50, 1149.31, 1058.34, 994.65, 943.65, 901.00]
    score = [.3830, .2246, .2365, .2345, .2182, .1917, .1958, .1887, .1872]
    table = spark.createDataFrame([(k, i, s) for k, i, s in zip(range(2, 11), inertia, score)],
                                  "k int, inertia double, silhouette double")
    assert tuple(cluster.choose_k(table).first()) == (2, 3)
    assert tuple(cluster.choose_k(table, forced=6).first()) == (6, 3)
    tied = spark.createDataFrame([(2, 9.0, .5), (3, 8.0, .5)], "k int, inertia double, silhouette double")
    assert cluster.choose_k(tied).first()["chosen_k"] == 2


def plain_lloyd(x, centres, most=300):
    """One model at a time, all stations against all centres."""
    for _ in range(most):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        moved = np.array([x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
        if np.abs(moved - centres).max() <= lloyd.SETTLED:
            break
        centres = moved
    return centres, ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def test_all_models_at_once_equal_plain_lloyd_from_the_same_starts(spark):
    rng = np.random.default_rng(11)
    points = rng.normal(size=(150, 3)).round(3)
    rows = [(f"s{i}", "S", "C", 900, *map(float, p)) for i, p in enumerate(points)]
    features = spark.createDataFrame(rows, "station_id string, state_name string, city_name string, n_hours int, "
                                     + ", ".join(f"{c} double" for c in COLUMNS)).repartition(5)
    prepared = cluster.prepare(features, COLUMNS)
    fitted = lloyd.fit_all(prepared, range(2, 6), 3, seed=42)
    x = lloyd.sample_of(prepared, 150)
    assert len(fitted) == 12 and x.shape == (150, 3)
    for (k, restart), model in fitted.items():
        centres, cost = plain_lloyd(x, lloyd.starts(x, k, np.random.default_rng([42, k, restart])))
        assert np.abs(model.points - centres).max() < 1e-8 and model.cost == pytest.approx(cost, rel=1e-9)
    best = lloyd.best_of(fitted)
    assert all(best[k].cost == pytest.approx(min(m.cost for (j, _), m in fitted.items() if j == k)) for k in best)
    named = lloyd.label(prepared, {"a": best[2], "b": best[5]}).collect()
    for r in named:
        apart = {c: ((np.array(r["x"]) - best[k].points) ** 2).sum(1) for c, k in (("a", 2), ("b", 5))}
        assert all(r[c] == d.argmin() for c, d in apart.items())


def test_one_pass_serves_all_models(spark, blobs):
    prepared = cluster.prepare(blobs, COLUMNS)
    x = lloyd.sample_of(prepared, 40)
    models = [lloyd.starts(x, k, np.random.default_rng(k)) for k in (2, 3, 9)]
    for centres, (moved, cost) in zip(models, lloyd.step(lloyd._points(prepared), models)):
        near = ((x[:, None] - centres[None]) ** 2).sum(2)
        assert cost == pytest.approx(near.min(1).sum())
        for c in range(len(centres)):
            own = x[near.argmin(1) == c]
            assert np.allclose(moved[c], own.mean(0) if len(own) else centres[c])
    # More centres than distinct points, and points that are all alike.
    alike = blobs.withColumns({c: F.lit(1.0) for c in COLUMNS})
    assert cluster.fit(cluster.prepare(alike, COLUMNS), 4, restarts=2).cost == 0


def test_distances_from_products_keep_their_digits():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(700, 8)) + 1e6
    b = np.concatenate([a[:600], a[:600] + 1e-5, rng.normal(size=(100, 8)) + 1e6])
    for x, y in ((a, b), (a, np.where(b == b[3, 3], np.inf, b))):
        found = np.full((len(x), len(y)), -1.0)
        for rows, columns, apart in cluster._distances(x, y):
            found[rows, columns] = apart
        with np.errstate(invalid="ignore"):
            want = np.sqrt(((x[:, None] - y[None]) ** 2).sum(2))
        assert np.allclose(found, want, rtol=1e-8, atol=0, equal_nan=True)


def test_each_pair_of_blocks_is_one_cell(spark):
    rng = np.random.default_rng(6)
    x, labels = rng.normal(size=(90, 3)), rng.integers(0, 3, 90)
    points = spark.createDataFrame([(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(x, labels))],
                                   "i int, x array<float>, own int")
    out = cluster.silhouette(points, {"own": 3}, "x", "i", block_rows=9).first()["silhouette"]
    assert out == pytest.approx(brute_silhouette(x.astype(np.float32).astype(float), labels), abs=1e-9)
    block = lambda n, i, j, at: pa.table({"_id": pa.array(range(at, at + n)), "_x": pa.array(x[at:at + n].tolist()),
                                          "own": pa.array(labels[at:at + n], pa.int32()), "_i": [i] * n, "_j": [j] * n})
    apart = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    rows = cluster._distance_sums(block(20, 0, 1, 0), block(30, 0, 1, 20), {"own": 3}).to_pylist()
    assert [r["_id"] for r in rows] == list(range(50))   # both sides, from one comparison
    for r in rows:
        others = range(20, 50) if r["_id"] < 20 else range(20)
        for c in range(3):
            assert r[f"_s_own_{c}"] == pytest.approx(sum(apart[r["_id"], o] for o in others if labels[o] == c))
    assert cluster._distance_sums(block(20, 1, 1, 0), block(20, 1, 1, 0), {"own": 3}).num_rows == 20


def test_many_stations_are_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(cluster, "PART_ROWS", 100)
    rows = spark.range(1000).select(F.concat(F.lit("s"), "id").alias("station_id"), F.lit("S").alias("state_name"),
                                    F.lit("C").alias("city_name"), F.lit(900).alias("n_hours"),
                                    *[F.rand(i).alias(c) for i, c in enumerate(COLUMNS)]).coalesce(1)
    parts = cluster.prepare(rows, COLUMNS).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) == 10 and max(r["count"] for r in parts) < 200


def test_k_table_of_natural_stations_is_whole(spark):
    folder = SF_DIR.replace("0.001", "0.01")  # a hundred stations
    table = {r["k"]: r for r in QUERIES["m4_k_table"](spark, folder).collect()}
    assert sorted(table) == list(range(2, 11)) and {r["measure"] for r in table.values()} == {"euclidean"}
    prepared = cluster.prepare(Tables(spark, folder).bulk_features, LINES.averages)
    models = cluster.fit_each(prepared, range(2, 11))
    labels = lloyd.label(prepared, {f"k{k}": m for k, m in models.items()}).collect()
    x = np.array([r["x"] for r in labels])
    for k, row in table.items():
        own = np.array([r[f"k{k}"] for r in labels])
        assert row["inertia"] == pytest.approx(sum(((x[own == c] - x[own == c].mean(0)) ** 2).sum() for c in set(own)), abs=0.01)
        assert row["silhouette"] == pytest.approx(brute_silhouette(x, own), abs=1e-4)
    best = max(table, key=lambda k: (table[k]["silhouette"], -k))
    drops = {k: abs(table[k]["inertia"] - table[k - 1]["inertia"]) / table[k]["inertia"] for k in range(3, 11)}
    choice = QUERIES["m5_natural_choice"](spark, folder).first()
    assert choice["chosen_k"] == best and choice["elbow_k"] == max(drops, key=lambda k: (drops[k], -k))
