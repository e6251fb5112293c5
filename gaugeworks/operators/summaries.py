"""Location, calendar and per-metric summaries of the clean long table.

Distinct counts are never taken over readings directly.  Readings are first
reduced to one partial row per station within the group (count, sum, extremes),
and the summary is built from those: the shuffle carries stations, not readings,
and a group holding a third of all rows is spread over its stations.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.statistics import percentage, when_metric
from gaugeworks.functions.timeparts import format_timestamp
from gaugeworks.model import UNKNOWN, MetricSpec
from gaugeworks.operators.quantiles import percentiles


def _partials(spec: MetricSpec, value: str = "reading") -> list[Column]:
    """Sum and count per metric: the mergeable state of a mean."""
    return [agg for m in spec for agg in (
        F.sum(when_metric(m.name, value)).alias(f"{m.short}_sum"),
        F.count(when_metric(m.name, value)).alias(f"{m.short}_n"))]


def _merged_mean(short: str) -> Column:
    return F.try_divide(F.sum(f"{short}_sum"), F.sum(f"{short}_n"))


def corpus_overview(readings: DataFrame) -> DataFrame:
    """Seven headline facts as (metric, value) text rows, from one pass."""
    stations = readings.groupBy("station_id", "city_name", "state_name").agg(
        F.count("*").alias("n"), F.min("collected_at").alias("first"),
        F.max("collected_at").alias("last"))
    unknown = F.when(F.col("city_name") == UNKNOWN, F.col("n")).otherwise(0)
    facts = {
        "readings": F.sum("n"),
        "distinct stations": F.count_distinct("station_id"),
        "distinct cities": F.count_distinct("city_name"),
        "distinct states": F.count_distinct("state_name"),
        "min timestamp": format_timestamp(F.min("first")),
        "max timestamp": format_timestamp(F.max("last")),
        "cities labelled Unknown": F.sum(unknown),
    }
    row = stations.agg(*[fact.cast("string").alias(name) for name, fact in facts.items()])
    return row.unpivot([], list(facts), "metric", "value")


def overall_means(readings: DataFrame, spec: MetricSpec) -> DataFrame:
    """Mean of each metric over everything, and the stations that report the primary one."""
    p = spec.primary.short
    stations = readings.groupBy("station_id").agg(*_partials(spec))
    return stations.agg(F.count_if(F.col(f"{p}_n") > 0).alias(f"stations_{p}"),
                        *[_merged_mean(m.short).alias(m.average) for m in spec])


def stations_per_metric(readings: DataFrame, spec: MetricSpec) -> DataFrame:
    """Conditional distinct count: stations that report each metric, side by side."""
    stations = readings.groupBy("station_id").agg(
        *[F.count(when_metric(m.name)).alias(m.short) for m in spec])
    return stations.agg(*[F.count_if(F.col(m.short) > 0).alias(f"stations_{m.short}")
                          for m in spec])


def city_summary(readings: DataFrame, spec: MetricSpec) -> DataFrame:
    """Stations, readings, mean, minimum and maximum of the primary metric per city."""
    p = spec.primary
    per_station = (readings.where(F.col("parameter_name") == p.name)
                   .groupBy("city_name", "station_id")
                   .agg(F.count("*").alias("n"), F.sum("reading").alias("s"),
                        F.min("reading").alias("lo"), F.max("reading").alias("hi")))
    return per_station.groupBy("city_name").agg(
        F.count("*").alias("stations"), F.sum("n").alias("readings"),
        (F.sum("s") / F.sum("n")).alias(p.average),
        F.min("lo").alias(f"{p.short}_min"), F.max("hi").alias(f"{p.short}_max"))


def city_ranking(readings: DataFrame, spec: MetricSpec, min_stations: int = 3,
                 top: int | None = 15) -> DataFrame:
    """Cities with enough stations, highest mean first; ``top=None`` keeps all of them."""
    ranked = city_summary(readings, spec).where(F.col("stations") >= min_stations)
    if top is None:
        return ranked
    return ranked.orderBy(F.desc(spec.primary.average), "city_name").limit(top)


def place_levels(readings: DataFrame, spec: MetricSpec) -> DataFrame:
    """Cities, states and the whole network from one pass over the readings.

    Readings become one partial row per station and place; the three levels are grouping sets
    over those.  ``level`` tells them apart, so a place without a name is no total.
    """
    p = spec.primary
    stations = (readings.groupBy("state_name", "city_name", "station_id")
                .agg(F.count("*").alias("readings"), *_partials(spec),
                     F.min(when_metric(p.name)).alias("lo"), F.max(when_metric(p.name)).alias("hi")))
    sets = [["state_name", "city_name"], ["state_name"], []]
    level = F.when(F.grouping_id() == 0, "city").when(F.grouping_id() == 1, "state").otherwise("network")
    return (stations.groupingSets(sets, "state_name", "city_name")
            .agg(level.alias("level"), F.count_distinct("city_name", "state_name").alias("cities"),
                 F.count_distinct("station_id").alias("stations"), F.sum("readings").alias("readings"),
                 *[_merged_mean(m.short).alias(m.average) for m in spec],
                 F.min("lo").alias(f"{p.short}_min"), F.max("hi").alias(f"{p.short}_max")))


def floor_audit(readings: DataFrame, spec: MetricSpec, min_stations: int = 3) -> DataFrame:
    """How many cities the station floor keeps and excludes."""
    enough = F.col("stations") >= min_stations
    return city_summary(readings, spec).agg(
        F.count("*").alias("cities"), F.count_if(enough).alias("kept"),
        F.count_if(~enough).alias("excluded"))


def state_ranking(readings: DataFrame, spec: MetricSpec, top: int | None = 15,
                  shown: int = 3) -> DataFrame:
    """Distinct cities, stations and the first few metric means per state."""
    first = list(spec)[:shown]
    stations = readings.groupBy("state_name", "city_name", "station_id").agg(*_partials(first))
    ranked = stations.groupBy("state_name").agg(
        F.count_distinct("city_name").alias("cities"),
        F.count_distinct("station_id").alias("stations"),
        *[_merged_mean(m.short).alias(m.average) for m in first])
    if top is None:
        return ranked
    return ranked.orderBy(F.desc_nulls_last(spec.primary.average), "state_name").limit(top)


def state_ranking_where_primary(wide: DataFrame, spec: MetricSpec, shown: int = 3) -> DataFrame:
    """The same per state over station-hours on which the primary metric is present."""
    first = list(spec)[:shown]
    stations = (wide.na.drop(subset=[spec.primary.column])
                .groupBy("state_name", "city_name", "station_id")
                .agg(*[agg for m in first for agg in (
                    F.sum(m.column).alias(f"{m.short}_sum"),
                    F.count(m.column).alias(f"{m.short}_n"))]))
    return stations.groupBy("state_name").agg(
        F.count_distinct("city_name").alias("cities"),
        F.count_distinct("station_id").alias("stations"),
        *[_merged_mean(m.short).alias(m.average) for m in first])


def monthly_primary(readings: DataFrame, spec: MetricSpec) -> DataFrame:
    """Mean and count of the primary metric per month, in calendar order."""
    return (readings.where(F.col("parameter_name") == spec.primary.name)
            .groupBy("year", "month")
            .agg(F.avg("reading").alias(spec.primary.average), F.count("*").alias("readings"))
            .orderBy("year", "month"))


def monthly_means(readings: DataFrame, spec: MetricSpec) -> DataFrame:
    """Mean of every metric per month, side by side."""
    return (readings.groupBy("year", "month")
            .agg(*[F.avg(when_metric(m.name)).alias(m.average) for m in spec])
            .orderBy("year", "month"))


def hourly_profile(readings: DataFrame, spec: MetricSpec) -> DataFrame:
    """Mean of each metric by hour of day, over all readings of that hour."""
    return (readings.groupBy("hour")
            .agg(*[F.avg(when_metric(m.name)).alias(m.average) for m in spec],
                 F.count("*").alias("readings"))
            .orderBy("hour"))


def hourly_profile_where_primary(wide: DataFrame, spec: MetricSpec) -> DataFrame:
    """The profile over station-hours on which the primary metric is present."""
    return (wide.na.drop(subset=[spec.primary.column]).groupBy("hour")
            .agg(*[F.avg(m.column).alias(m.average) for m in spec],
                 F.count("*").alias("readings"))
            .orderBy("hour"))


def peak_and_trough(profile: DataFrame, spec: MetricSpec, axis: str = "hour") -> DataFrame:
    """Where on the axis each metric is highest and lowest; the earlier place wins a tie."""
    long = (profile.unpivot([axis], spec.averages, "_average", "mean")
            .where(F.col("mean").isNotNull()))
    best = long.groupBy("_average").agg(
        F.max(F.struct("mean", (-F.col(axis)).alias("back"))).alias("hi"),
        F.min(F.struct("mean", axis)).alias("lo"))
    return best.select(
        F.regexp_replace("_average", "_avg$", "").alias("metric"),
        (-F.col("hi.back")).alias(f"peak_{axis}"), F.col("hi.mean").alias("peak_mean"),
        F.col(f"lo.{axis}").alias(f"trough_{axis}"), F.col("lo.mean").alias("trough_mean"))


def population_statistics(readings: DataFrame, spec: MetricSpec) -> DataFrame:
    """n, mean, extremes, population deviation and variance; one row per specified metric."""
    stats = readings.groupBy("parameter_name").agg(
        F.count("reading").alias("n"), F.avg("reading").alias("mean_value"),
        F.min("reading").alias("min_value"), F.max("reading").alias("max_value"),
        F.stddev_pop("reading").alias("stddev"), F.var_pop("reading").alias("variance"))
    metrics = spec.frame(readings.sparkSession).select("pollutant")
    return (metrics.join(stats, F.col("pollutant") == F.col("parameter_name"), "left")
            .select("pollutant", F.coalesce("n", F.lit(0)).alias("n"), "mean_value",
                    "min_value", "max_value", "stddev", "variance"))


def sample_statistics(wide: DataFrame, spec: MetricSpec, exact: bool = True) -> DataFrame:
    """n, missing, mean, median, extremes, sample variance and deviation per metric.

    The median is exact by default; see ``quantiles`` for how it stays
    distributed.  ``exact=False`` takes a mergeable sketch in the same pass.
    """
    values = wide.select(*spec.columns).unpivot([], spec.columns, "metric", "value")
    aggregates = [
        F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("missing"),
        F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.var_samp("value").alias("variance"), F.stddev_samp("value").alias("stddev")]
    if exact:
        median = (percentiles(values, "value", [0.5], ["metric"], len(spec))
                  .select(F.col("metric").alias("_m"), F.col("percentile").alias("median")))
        stats = (values.groupBy("metric").agg(*aggregates)
                 .join(median, F.col("metric") == F.col("_m"), "left"))
    else:
        stats = values.groupBy("metric").agg(
            *aggregates, F.percentile_approx("value", 0.5, 10000).alias("median"))
    names = spec.frame(wide.sparkSession).select(
        F.col("pollutant"), F.element_at(F.create_map(*[F.lit(x) for m in spec for x in (
            m.name, m.column)]), F.col("pollutant")).alias("metric"))
    return (stats.where(F.col("n") > 0).join(names, "metric")
            .select("pollutant", "n", "missing", "mean", "median", "min", "max", "variance",
                    "stddev"))


def city_metric_summary(readings: DataFrame) -> DataFrame:
    """Count, mean, minimum and maximum per city and metric, over every kept reading."""
    return (readings.groupBy(F.col("city_name").alias("city"),
                             F.col("parameter_name").alias("pollutant"))
            .agg(F.count("reading").alias("reading_count"), F.avg("reading").alias("mean"),
                 F.min("reading").alias("min"), F.max("reading").alias("max")))


def summary_counters(summary: DataFrame) -> DataFrame:
    """Readings and groups behind a city x metric summary."""
    return summary.agg(F.sum("reading_count").alias("readings"), F.count("*").alias("pairs"))


def coverage(wide: DataFrame, spec: MetricSpec) -> DataFrame:
    """Present and missing cells per metric, over all station-hours."""
    counts = wide.agg(F.count("*").alias("_total"),
                      *[F.count(m.column).alias(m.name) for m in spec])
    return (counts.unpivot(["_total"], [f"`{n}`" for n in spec.names], "pollutant", "present")
            .select("pollutant", "present", (F.col("_total") - F.col("present")).alias("missing"),
                    percentage(F.col("_total") - F.col("present"), F.col("_total"))
                    .alias("missing_pct")))


def wide_distincts(wide: DataFrame) -> DataFrame:
    """Station-hours, distinct stations, cities and states, and rows without a known city."""
    stations = wide.groupBy("station_id", "city_name", "state_name").agg(F.count("*").alias("n"))
    unknown = F.when(F.col("city_name") == UNKNOWN, F.col("n")).otherwise(0)
    return stations.agg(
        F.sum("n").alias("station_hours"), F.count_distinct("station_id").alias("stations"),
        F.count_distinct("city_name").alias("cities"),
        F.count_distinct("state_name").alias("states"), F.sum(unknown).alias("unknown_city_rows"))


def station_profiles(wide: DataFrame, spec: MetricSpec) -> DataFrame:
    """Hours and mean of each metric per station, over hours with the primary metric."""
    return (wide.na.drop(subset=[spec.primary.column]).groupBy("station_id")
            .agg(F.max("state_name").alias("state_name"), F.max("city_name").alias("city_name"),
                 F.count("*").alias("n_hours"),
                 *[F.avg(m.column).alias(m.average) for m in spec]))


def _eligible(spec: MetricSpec, min_hours: int, require_all: bool) -> Column:
    rule = F.col("n_hours") >= min_hours
    if require_all:
        for name in spec.averages:
            rule = rule & F.col(name).isNotNull()
    return rule


def station_features(wide: DataFrame, spec: MetricSpec, min_hours: int = 500,
                     require_all: bool = True) -> DataFrame:
    """The clustering input: stations with enough hours and, by default, every metric."""
    return station_profiles(wide, spec).where(_eligible(spec, min_hours, require_all))


def feature_funnel(wide: DataFrame, spec: MetricSpec, min_hours: int = 500) -> DataFrame:
    """Stations left after each eligibility rule."""
    every = _eligible(spec, 0, True)
    long_enough = F.col("n_hours") >= min_hours
    row = station_profiles(wide, spec).agg(
        F.count("*").alias("stations with the primary metric"),
        F.count_if(long_enough).alias("stations with enough hours"),
        F.count_if(every).alias("stations with all metrics"),
        F.count_if(long_enough & every).alias("stations in feature table"))
    return row.unpivot([], row.columns, "metric", "value")


def extreme_stations(features: DataFrame, spec: MetricSpec, top: int = 10) -> DataFrame:
    """The cleanest and the most polluted stations by the primary mean."""
    key = spec.primary.average
    clean = features.orderBy(F.asc(key), "station_id").limit(top)
    dirty = features.orderBy(F.desc(key), "station_id").limit(top)
    return (clean.withColumn("end", F.lit("cleanest"))
            .unionByName(dirty.withColumn("end", F.lit("dirtiest"))))
