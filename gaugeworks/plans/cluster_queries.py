"""Queries over station clustering.

K-means itself has no SQL form, so it runs over stations planted in three groups far
apart, which the best fit must find: the SQL takes the groups as planted.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.operators import checks, cluster
from gaugeworks.plans.oracle import ev, li
from gaugeworks.plans.registry import query
from gaugeworks.plans.tables import EVENTS, LINES, MIN_HOURS, PLANTED_APART
from gaugeworks.session import cut_lineage

FEATURES = EVENTS.averages
PLANTED = LINES.averages


def _prepared(t):
    return cluster.prepare(t.planted, PLANTED)


def _clusters(t, k: int = 3):
    prepared = _prepared(t)
    return cluster.assign(prepared, cluster.fit(prepared, k), PLANTED)


_FEATURE_SQL = f"""
WITH f AS (SELECT station_id, {ev("avg({c}) AS {s}_avg")} FROM days WHERE click_ug_m3 IS NOT NULL
  GROUP BY station_id HAVING count(*) >= {MIN_HOURS} AND {ev("count({c}) > 0", " AND ")})"""


@query("m2_scaled_features", f"""{_FEATURE_SQL}
SELECT station_id, {ev("round(({s}_avg - (SELECT avg({s}_avg) FROM f)) / (SELECT stddev_pop({s}_avg) FROM f), 4) AS z_{s}_avg")}
FROM f""")
def _(t):
    return cluster.scale(t.features, FEATURES).select("station_id", *[f"z_{c}" for c in FEATURES])


@query("m2_feature_spread", f"""{_FEATURE_SQL},
s AS ({ev("SELECT '{s}_avg' AS feature, avg({s}_avg) AS mean, stddev_pop({s}_avg) AS stddev FROM f", " UNION ALL ")})
SELECT feature, round(mean, 4) AS mean, round(stddev, 4) AS stddev,
  round((SELECT max(stddev) / min(stddev) FROM s), 4) AS spread_ratio FROM s""")
def _(t):
    return cluster.spread_table(t.features, FEATURES)


_PLANTED_SQL = f"""
WITH g AS (SELECT station_id, CAST(station_id % 3 AS INTEGER) AS cluster, count(*) AS n_hours,
    max(a.state_name) AS state_name, max(a.city_name) AS city_name,
    {li("avg({c}) + (station_id % 3) * CAST(" + str(PLANTED_APART) + " AS DOUBLE) AS {s}_avg")}
  FROM lcells JOIN lattrs a USING (station_id) WHERE quantity_ug_m3 IS NOT NULL GROUP BY station_id
  HAVING count(*) >= {MIN_HOURS} AND {li("count({c}) > 0", " AND ")}),
z AS (SELECT station_id, cluster, {li("({s}_avg - (SELECT avg({s}_avg) FROM g)) / (SELECT stddev_pop({s}_avg) FROM g) AS {s}")}
  FROM g),
c AS (SELECT cluster, {li("avg({s}) AS {s}_c")} FROM z GROUP BY cluster),
inertia AS (SELECT round(sum({li("({s} - {s}_c) ** 2", " + ")}), 4) AS inertia FROM z JOIN c USING (cluster)),
pairs AS (SELECT a.station_id, a.cluster AS own, b.cluster AS other, count(*) AS n,
    sum(sqrt({li("(a.{s} - b.{s}) ** 2", " + ")})) AS total FROM z a CROSS JOIN z b GROUP BY ALL),
scores AS (SELECT station_id, max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS inside,
    min(CASE WHEN own <> other THEN total / n END) AS outside FROM pairs GROUP BY station_id),
profile AS (SELECT cluster, count(*) AS stations, count(DISTINCT city_name) AS cities,
    {li("round(avg({s}_avg), 2) AS {s}_avg")} FROM g GROUP BY cluster)"""


@query("m3_best_of_restarts", f"{_PLANTED_SQL} SELECT profile.*, inertia FROM profile CROSS JOIN inertia")
def _(t):
    prepared = _prepared(t)
    model = cluster.fit(prepared, 3)
    return cluster.cluster_profile(cluster.assign(prepared, model, PLANTED), PLANTED).withColumn(
        "inertia", F.lit(round(float(model.cost), 4)))


@query("m4_planted_k", f"""{_PLANTED_SQL}
SELECT CAST(3 AS INTEGER) AS k, round(inertia, 2) AS inertia,
  (SELECT round(avg(coalesce((outside - inside) / greatest(inside, outside), 0)), 4) FROM scores) AS silhouette,
  'euclidean' AS measure, true AS more_clusters_cost_less FROM inertia""")
def _(t):
    table = cut_lineage(cluster.scan_k(_prepared(t))[0])
    falls = table.agg(F.sort_array(F.collect_list(F.struct("k", "inertia"))).alias("t")).select(
        F.forall(F.sequence(F.lit(1), F.size("t") - 1),
                 lambda i: F.get("t", i)["inertia"] <= F.get("t", i - 1)["inertia"])).scalar()
    return table.where("k = 3").withColumn("more_clusters_cost_less", falls)


def _natural(t):
    """Stations as they are: one cloud, or however many groups their means form."""
    return cluster.prepare(t.bulk_features, PLANTED)


# The whole scan has no SQL form: tests compare it with Lloyd's steps from the same starts.
@query("m4_k_table")
def _(t):
    return cluster.scan_k(_natural(t))[0]


@query("m5_natural_choice")
def _(t):
    return cluster.choose_k(cut_lineage(cluster.scan_k(_natural(t))[0]))


@query("m5_choice_of_k", f"""{_PLANTED_SQL}
SELECT CAST(count(*) AS INTEGER) AS chosen_k, CAST(count(*) AS INTEGER) AS elbow_k FROM profile""")
def _(t):
    return cluster.choose_k(cluster.scan_k(_prepared(t))[0])


@query("m6_silhouette", """
WITH p AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings),
d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.x, b.x)) AS total,
    count(*) AS n FROM p a CROSS JOIN p b GROUP BY ALL),
m AS (SELECT vec_id, max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS inside,
    min(CASE WHEN own <> other THEN total / n END) AS outside FROM d GROUP BY vec_id)
SELECT 'label' AS labelling,
  round(avg(coalesce((outside - inside) / greatest(inside, outside), 0)), 4) AS silhouette FROM m""")
def _(t):
    points = t.table("embeddings")
    labels = points.agg(F.max("label").alias("top")).first()["top"] + 1
    return cluster.silhouette(points, {"label": labels}, "embedding", "vec_id")


@query("m7_assignments", f"""{_PLANTED_SQL} SELECT station_id, state_name, city_name, n_hours, cluster,
  {li("round({s}_avg, 4) AS {s}_avg")} FROM g""")
def _(t):
    return _clusters(t)


@query("a30_cluster_profile", f"{_PLANTED_SQL} SELECT * FROM profile")
def _(t):
    return cluster.cluster_profile(_clusters(t), PLANTED)


@query("a31_cluster_centres", f"""{_PLANTED_SQL} SELECT cluster, round(avg(quantity_avg), 4) AS quantity_avg,
  round(avg(price_avg), 4) AS price_avg FROM g GROUP BY cluster""")
def _(t):
    return cluster.cluster_centres(_clusters(t), "quantity_avg", "price_avg")


@query("o6_mixed_order", f"""{_PLANTED_SQL} SELECT cluster, round(quantity_avg, 4) AS quantity_avg, station_id FROM g
ORDER BY cluster, quantity_avg DESC, station_id""")
def _(t):
    return _clusters(t).select("cluster", "quantity_avg", "station_id").orderBy(
        F.asc("cluster"), F.desc("quantity_avg"), F.asc("station_id"))


@query("q19_cluster_coverage", f"""{_PLANTED_SQL}
SELECT count(*) AS assigned, count(*) AS stations, CAST(3 AS BIGINT) AS clusters,
  count(*) AS eligible, true AS covered FROM g""")
def _(t):
    return checks.cluster_coverage(_clusters(t), t.planted)


@query("r7_cluster_scatter", f"""{_PLANTED_SQL} SELECT station_id, cluster, stations, round(g.quantity_avg, 4) AS quantity_avg,
  round(g.price_avg, 4) AS price_avg FROM g JOIN profile USING (cluster)""")
def _(t):
    points = _clusters(t)
    sizes = points.groupBy("cluster").agg(F.count("*").alias("stations"))
    return points.join(sizes, "cluster").select("station_id", "cluster", "stations", "quantity_avg",
                                                "price_avg")
