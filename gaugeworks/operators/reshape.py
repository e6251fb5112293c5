"""Long to wide and back."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.statistics import when_metric
from gaugeworks.functions.timeparts import day_of, time_parts
from gaugeworks.model import MetricSpec

STATION_HOUR = ["station_id", "collected_at"]
LOCATION = ["state_name", "city_name", "source"]


def pivot_mean(readings: DataFrame, spec: MetricSpec, keys: list[str] = STATION_HOUR,
               carry: list[str] = ()) -> DataFrame:
    """One row per key with the mean reading of each metric.

    Conditional averages rather than the pivot clause: one shuffle instead of
    two, and the column list is fixed by the specification.
    """
    return readings.groupBy(*keys).agg(
        *[F.avg(when_metric(m.name)).alias(m.column) for m in spec],
        *[F.max(c).alias(c) for c in carry])


def located_hours(kept: DataFrame, spec: MetricSpec) -> DataFrame:
    """Kept readings straight to one row per station, hour and location label.

    Averages duplicates and pivots in the same shuffle.  Metrics of one hour
    meet before that shuffle when they were read together, so it carries
    station-hours instead of readings.
    """
    return pivot_mean(kept, spec, [*STATION_HOUR, *LOCATION])


def merge_locations(hours: DataFrame, spec: MetricSpec) -> DataFrame:
    """One row per station-hour: the mean over its location labels, the greatest label kept."""
    return hours.groupBy(*STATION_HOUR).agg(
        *[F.avg(m.column).alias(m.column) for m in spec],
        F.max("state_name").alias("state_name"), F.max("city_name").alias("city_name"))


def daily_means(hours: DataFrame, spec: MetricSpec) -> DataFrame:
    """One row per station and day: the mean of its hourly values."""
    return hours.groupBy("station_id", day_of(F.col("collected_at")).alias("date")).agg(
        *[F.avg(m.column).alias(m.column) for m in spec],
        F.max("state_name").alias("state_name"), F.max("city_name").alias("city_name"))


def pivot_max(readings: DataFrame, spec: MetricSpec, keys: list[str] = STATION_HOUR) -> DataFrame:
    """The same shape by maximum, with the location carried along."""
    return readings.groupBy(*keys).agg(
        F.max("state_name").alias("state_name"), F.max("city_name").alias("city_name"),
        *[F.max(when_metric(m.name)).alias(m.column) for m in spec])


def attach_attributes(wide: DataFrame, attributes: DataFrame) -> DataFrame:
    """Left join of one attribute row per station.

    No broadcast hint: the attribute table grows with the number of stations.
    Adaptive execution broadcasts it when its measured size allows and
    otherwise splits the partitions of a station that holds many hours.
    """
    bare = wide.drop(*[c for c in attributes.columns if c != "station_id"])
    return bare.join(attributes, "station_id", "left")


def wide_table(wide: DataFrame, attributes: DataFrame, spec: MetricSpec) -> DataFrame:
    """The pinned wide layout: keys, calendar parts, one column per metric, attributes."""
    return (attach_attributes(wide, attributes)
            .select("*", *time_parts(F.col("collected_at")))
            .select("station_id", "collected_at", "year", "month", "day", "hour",
                    *spec.columns, "state_name", "city_name", "source"))


def pin_columns(df: DataFrame, columns: list[str], numeric: list[str] = ()) -> DataFrame:
    """Project to an exact column list; a numeric column that is absent becomes NULL."""
    have = set(df.columns)
    return df.select(*[
        F.col(c) if c in have else F.lit(None).cast("double" if c in numeric else "string").alias(c)
        for c in columns])


def complete_cases(wide: DataFrame, spec: MetricSpec) -> DataFrame:
    """Rows on which every metric is present: what joining the metrics one by one would keep."""
    return wide.na.drop(subset=spec.columns)


def rename_metrics(df: DataFrame, spec: MetricSpec) -> DataFrame:
    """Wide column names to metric names."""
    return df.withColumnsRenamed({m.column: m.name for m in spec})


def unpivot_wide(wide: DataFrame, spec: MetricSpec, keep: list[str]) -> DataFrame:
    """One row per present cell, keyed by metric name."""
    cells = F.inline(F.array(*[F.struct(F.lit(m.name).alias("parameter_name"),
                                        F.col(m.column).alias("reading")) for m in spec]))
    return wide.select(*keep, cells).where(F.col("reading").isNotNull())
