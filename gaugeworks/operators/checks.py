"""Assertions about results, each a one-row or one-row-per-subject relation."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.model import MetricSpec
from gaugeworks.operators.exceed import with_limits


def counts_agree(left: DataFrame, right: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Keys on which two independently computed counts differ, or that only one side has."""
    a = left.select(*keys, F.col(count).alias("left_count"))
    b = right.select(*keys, F.col(count).alias("right_count"))
    return (a.join(b, keys, "full")
            .where(~F.col("left_count").eqNullSafe(F.col("right_count"))))


def totals_agree(left: DataFrame, right: DataFrame, count: str) -> DataFrame:
    """One row: the two totals and whether they are equal."""
    total = left.agg(F.sum(count).alias("left_total"))
    other = right.agg(F.sum(count).alias("n")).scalar()
    return (total.withColumn("right_total", other)
            .withColumn("agree", F.col("left_total") == F.col("right_total")))


def reshape_preserved(readings: DataFrame, wide: DataFrame, spec: MetricSpec) -> DataFrame:
    """Every long reading must be one non-null wide cell."""
    cells = wide.agg(*[F.count(m.column).alias(m.column) for m in spec])
    total = sum((F.col(m.column) for m in spec), F.lit(0)).cast("bigint")
    rows = readings.agg(F.count("*").alias("n")).scalar()
    return (cells.select(total.alias("wide_cells"), rows.alias("long_rows"))
            .withColumn("preserved", F.col("wide_cells") == F.col("long_rows")))


def matrix_checks(cells: DataFrame, bound: float = 1.0001) -> DataFrame:
    """Symmetric, unit diagonal, within range."""
    r, mirrored = F.col("correlation"), F.greatest("row_metric", "column_metric")
    halves = cells.groupBy(F.least("row_metric", "column_metric").alias("a"),
                           mirrored.alias("b")).agg(
        F.max(r).alias("hi"), F.min(r).alias("lo"), F.count("*").alias("n"))
    diagonal = F.col("a") == F.col("b")
    return halves.agg(
        F.sum("n").alias("cells"),
        F.coalesce(F.bool_and(F.col("hi") == F.col("lo")), F.lit(True)).alias("symmetric"),
        F.bool_and(~diagonal | ((F.col("hi") == 1.0) & (F.col("n") == 1))).alias("unit_diagonal"),
        F.coalesce(F.bool_and((F.col("hi") <= bound) & (F.col("lo") >= -bound)), F.lit(True))
        .alias("in_range"))


def plausibility(readings: DataFrame, spec: MetricSpec) -> DataFrame:
    """Per metric: extremes, and readings below zero or above the ceiling."""
    joined = with_limits(readings, spec)
    return (joined.groupBy("pollutant", "ceiling")
            .agg(F.min("reading").alias("min"), F.max("reading").alias("max"),
                 F.count_if(F.col("reading") < 0).alias("negative"),
                 F.count_if(F.col("reading") > F.col("ceiling")).alias("above_ceiling"))
            .withColumn("plausible", (F.col("negative") == 0) & (F.col("above_ceiling") == 0)))


def conversion_check(readings: DataFrame, metric: str, at_least: float) -> DataFrame:
    """Whether unit conversion reached a metric: no reading small enough to be unconverted.

    Looks at every reading of the metric, not at the first one.
    """
    of_metric = F.col("parameter_name") == metric
    return readings.agg(
        F.count("*").alias("rows"),
        F.count_if(of_metric).alias("metric_rows"),
        F.count_if(of_metric & (F.col("reading") > at_least)).alias("converted_rows"),
        F.count_if(F.col("month").isNull()).alias("rows_without_month"))


def cluster_coverage(assignments: DataFrame, features: DataFrame) -> DataFrame:
    """Every station with complete features is assigned exactly once, to at least two clusters."""
    eligible = features.agg(F.count("*").alias("n")).scalar()
    return (assignments.agg(F.count("*").alias("assigned"),
                            F.count_distinct("station_id").alias("stations"),
                            F.count_distinct("cluster").alias("clusters"))
            .withColumn("eligible", eligible)
            .withColumn("covered", (F.col("assigned") == F.col("eligible"))
                        & (F.col("stations") == F.col("eligible")) & (F.col("clusters") >= 2)))
