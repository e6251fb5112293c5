"""The whole batch analysis: raw readings in, staged tables and result files out."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.model import AIR_QUALITY, MetricSpec
from gaugeworks.operators import clean, cluster, correlate, exceed, profile, report, reshape, summaries
from gaugeworks.sources import writers


def stage(raw: DataFrame, spec: MetricSpec, out: str) -> tuple[DataFrame, DataFrame]:
    """Write the clean long and the wide table; return them as scans.

    Readings are scanned and shuffled once, into station-hours per location; both
    tables and the station attributes come from these.

    All analyses start from these files: they are pruned columnar scans, and a
    lost executor repeats a scan instead of the cleaning.
    """
    spark = raw.sparkSession
    hours_path = f"{out}/located_hours"
    reshape.located_hours(clean.kept_readings(raw, spec), spec).write.mode("overwrite").parquet(hours_path)
    located = spark.read.parquet(hours_path)
    writers.write_tree(clean.long_table(located, spec), f"{out}/clean")
    hours = reshape.merge_locations(located, spec)
    wide = reshape.wide_table(hours, clean.station_attributes(located), spec)
    writers.write_tree(wide, f"{out}/wide")
    return spark.read.parquet(f"{out}/clean"), spark.read.parquet(f"{out}/wide")


def analyses(readings: DataFrame, wide: DataFrame, spec: MetricSpec, min_stations: int = 3,
             min_hours: int = 500) -> dict[str, DataFrame]:
    """Every result that is computed from the staged readings, by name."""
    return {
        "overview": summaries.corpus_overview(readings),
        "city_ranking": summaries.city_ranking(readings, spec, min_stations, top=None),
        "state_ranking": summaries.state_ranking(readings, spec, top=None),
        "monthly": summaries.monthly_means(readings, spec),
        "hourly_profile": summaries.hourly_profile(readings, spec),
        "population_statistics": summaries.population_statistics(readings, spec),
        "sample_statistics": summaries.sample_statistics(wide, spec),
        "coverage": summaries.coverage(wide, spec),
        "correlation_pairs": correlate.correlation_pairs(wide, spec),
        "correlation_matrix": correlate.correlation_matrix(wide, spec),
        "station_features": summaries.station_features(wide, spec, min_hours),
        "thresholds": exceed.thresholds(readings, spec),
        "exceedance_counts": exceed.city_counts(wide, spec),
        "histogram": report.density_histogram(readings, spec),
    }


def exceedance(counts: DataFrame, spec: MetricSpec,
               min_observations: int = 30) -> dict[str, DataFrame]:
    """Every exceedance result, from the staged per-city counts."""
    cities = exceed.city_exceedance(counts, min_observations)
    by_city = exceed.exceedance_by_city(cities, spec)
    return {
        "exceedance_network": exceed.network_exceedance(counts, spec, min_observations),
        "exceedance_by_city": by_city,
        "exceedance_worst": exceed.worst_cities(by_city, spec),
        "exceedance_highlights": exceed.exceedance_highlights(cities),
    }


def run(spark: SparkSession, raw: DataFrame, out: str, spec: MetricSpec = AIR_QUALITY,
        ks=cluster.K_RANGE, restarts: int = cluster.RESTARTS, min_observations: int = 30,
        measure: str = "squaredEuclidean", **floors: int) -> dict[str, str]:
    """Audit, profile, stage, analyse, check and cluster; returns the path of every result.

    ``cluster_status`` says whether there were enough stations to cluster.
    """
    paths = {}

    def publish(name: str, df: DataFrame) -> None:
        paths[name] = f"{out}/results/{name}"
        df.write.mode("overwrite").parquet(paths[name])

    publish("audit", clean.audit(raw, spec))
    publish("reconciliation", clean.reconcile(raw, spec))
    publish("null_report", profile.null_report(raw))
    publish("time_range", profile.time_range(raw))
    publish("city_metric_summary", summaries.city_metric_summary(clean.kept_readings(raw, spec)))
    readings, wide = stage(raw, spec, out)
    for name, df in analyses(readings, wide, spec, **floors).items():
        publish(name, df)
    counts = spark.read.parquet(paths["exceedance_counts"])
    for name, df in exceedance(counts, spec, min_observations).items():
        publish(name, df)
    features = spark.read.parquet(paths["station_features"])
    complete = cluster.complete_stations(features, spec.averages)
    found = complete.agg(F.count("*").alias("n")).first()["n"]
    enough = found >= cluster.MIN_STATIONS
    publish("cluster_status", spark.range(1).select(
        F.lit("clustered" if enough else "too few stations").alias("status"),
        F.lit(found).alias("stations_found"), F.lit(cluster.MIN_STATIONS).alias("stations_needed")))
    if enough:
        for name, df in cluster.cluster_stations(complete, spec.averages, ks=ks, restarts=restarts,
                                                 measure=measure).items():
            publish(f"cluster_{name}", df)
    return paths
