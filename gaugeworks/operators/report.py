"""The relations behind charts and tables of a report."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.model import MetricSpec
from gaugeworks.operators.quantiles import percentiles


def top_cities(ranking: DataFrame, spec: MetricSpec, top: int = 20) -> DataFrame:
    """The highest cities, listed ascending as a bar chart draws them, labelled 'n of m'."""
    key = spec.primary.average
    total = ranking.agg(F.count("*").alias("n")).scalar()
    best = ranking.orderBy(F.desc(key), "city_name").limit(top)
    shown = F.least(F.lit(top).cast("bigint"), total)
    return (best.withColumn("label", F.format_string("%d of %d", shown, total))
            .orderBy(F.asc(key), F.desc("city_name")))


def largest(df: DataFrame, column: str, top: int, *ties: str) -> DataFrame:
    """The rows with the largest values, re-sorted ascending."""
    return (df.orderBy(F.desc_nulls_last(column), *ties).limit(top)
            .orderBy(F.asc(column), *[F.desc(t) for t in ties]))


def monthly_series(monthly: DataFrame, spec: MetricSpec) -> DataFrame:
    """The primary metric over time with a month label, gaps dropped."""
    label = F.date_format(F.make_date("year", "month", F.lit(1)), "MMM")
    return (monthly.na.drop(subset=[spec.primary.average])
            .select("year", "month", label.alias("label"), spec.primary.average))


def hour_labels(profile: DataFrame, *columns: str) -> DataFrame:
    """Chosen series of the daily profile with an 'HH:00' label."""
    return profile.select("hour", F.format_string("%02d:00", "hour").alias("label"), *columns)


def deviation_bands(stats: DataFrame) -> DataFrame:
    """Mean, mean plus one deviation, and maximum per metric."""
    return stats.select("pollutant", F.col("mean_value").alias("mean"),
                        (F.col("mean_value") + F.col("stddev")).alias("upper"),
                        F.col("max_value").alias("max"))


def bar_heights(series: DataFrame, column: str, floor: float = 2.0) -> DataFrame:
    """Each value as a share of the series maximum, never below the floor."""
    peak = series.agg(F.max(column).alias("peak")).scalar()
    return series.withColumn("height", F.greatest(
        F.lit(floor), F.try_divide(F.lit(100.0) * F.col(column), peak)))


def relative_change(series: DataFrame, order: str, column: str) -> DataFrame:
    """Absolute change against the previous step, as a share of the new value.

    For aggregated series (one row per k, hour, day): the window is unpartitioned.
    """
    before = F.lag(column).over(Window.orderBy(order))
    return series.withColumn("relative_change", F.try_divide(
        F.abs(F.col(column) - before), F.col(column)))


def trim_upper(readings: DataFrame, spec: MetricSpec, quantile: float = 0.99) -> DataFrame:
    """Readings at or below the given quantile of their metric.

    The cut-offs hold at most one row per specified metric, which bounds the broadcast.
    """
    of_spec = readings.where(F.col("parameter_name").isin(spec.names))
    cut = percentiles(of_spec, "reading", [quantile], ["parameter_name"], len(spec)).select(
        F.col("parameter_name").alias("_metric"), F.col("percentile").alias("_cut"))
    return (of_spec.join(F.broadcast(cut), F.col("parameter_name") == F.col("_metric"))
            .where(F.col("reading") <= F.col("_cut")).drop("_metric", "_cut"))


def density_histogram(readings: DataFrame, spec: MetricSpec, bins: int = 60,
                      quantile: float = 0.99) -> DataFrame:
    """Equal-width density histogram per metric after trimming; the last bin is closed.

    Every pass over the readings ends in an aggregate of fixed size, combined
    before its shuffle; the frames joined to them hold one row per specified metric.
    """
    metric, v = "parameter_name", F.col("reading")
    trimmed = trim_upper(readings, spec, quantile).select(metric, "reading")
    shape = trimmed.groupBy(metric).agg(
        F.min(v).alias("lo"), F.count(v).alias("total"),
        ((F.max(v) - F.min(v)) / F.lit(float(bins))).alias("width"))
    place = F.least(F.floor(F.try_divide(v - F.col("lo"), F.col("width"))),
                    F.lit(bins - 1).cast("bigint"))
    placed = (trimmed.join(F.broadcast(shape.select(metric, "lo", "width")), metric)
              .groupBy(metric, F.coalesce(place, F.lit(0)).cast("int").alias("bin"))
              .agg(F.count("*").alias("n")))
    frame = shape.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    n = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    return (frame.join(placed, [metric, "bin"], "left")
            .select(metric, "bin",
                    (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"),
                    n.alias("n"),
                    F.try_divide(n, F.col("total") * F.col("width")).alias("density")))


def headline(network: DataFrame) -> DataFrame:
    """Per metric: share above the limit and the worst city, for a page header."""
    return network.select("pollutant", "pct_above", "cities_with_mean_above", "worst_city",
                          "worst_city_pct_above")
