"""Metrics, units, limits and schemas, passed to every operator as data."""
from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DAILY = "24-hour"
EIGHT_HOUR = "8-hour"
UNKNOWN = "Unknown"
HOURS_PER_DAY = 24


def window_hours(window: str) -> int:
    """Length of an averaging time written as ``<n>-hour``; it must divide a day."""
    count, dash, unit = window.partition("-")
    if unit != "hour" or not count.isdecimal() or not int(count) or HOURS_PER_DAY % int(count):
        raise ValueError(f"averaging time must be '<n>-hour' with n dividing 24: {window!r}")
    return int(count)


@dataclass(frozen=True)
class Metric:
    """One measured quantity and the limits it is judged against."""

    name: str
    short: str
    limit: float
    window: str
    guideline: float
    guideline_window: str
    ceiling: float

    def __post_init__(self):
        window_hours(self.window)

    @property
    def hours(self) -> int:
        return window_hours(self.window)

    @property
    def column(self) -> str:
        return f"{self.short}_ug_m3"

    @property
    def average(self) -> str:
        return f"{self.short}_avg"


@dataclass(frozen=True)
class MetricSpec:
    """The metrics an analysis covers; the first one is the primary metric."""

    metrics: tuple[Metric, ...]

    def __iter__(self):
        return iter(self.metrics)

    def __len__(self) -> int:
        return len(self.metrics)

    @property
    def primary(self) -> Metric:
        return self.metrics[0]

    @property
    def names(self) -> list[str]:
        return [m.name for m in self.metrics]

    @property
    def columns(self) -> list[str]:
        return [m.column for m in self.metrics]

    @property
    def averages(self) -> list[str]:
        return [m.average for m in self.metrics]

    def only(self, *names: str) -> MetricSpec:
        return MetricSpec(tuple(m for m in self.metrics if m.name in names))

    def pairs(self) -> list[tuple[Metric, Metric]]:
        """Every unordered pair of metrics, in specification order."""
        return [(a, b) for i, a in enumerate(self.metrics) for b in self.metrics[i + 1:]]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The specification as a relation.

        Built from Arrow, so it is a local relation whose exact size the
        optimizer sees; it holds one row per metric and never grows with data.
        """
        return spark.createDataFrame(pa.table({
            "metric_order": pa.array(range(len(self)), pa.int32()),
            "pollutant": pa.array(self.names, pa.string()),
            "standard_ug_m3": pa.array([float(m.limit) for m in self], pa.float64()),
            "averaging_time": pa.array([m.window for m in self], pa.string()),
            "who_2021_ug_m3": pa.array([float(m.guideline) for m in self], pa.float64()),
            "who_averaging_time": pa.array([m.guideline_window for m in self], pa.string()),
            "ceiling": pa.array([float(m.ceiling) for m in self], pa.float64()),
        }))


# National limits, WHO 2021 guidelines and plausibility ceilings.
AIR_QUALITY = MetricSpec((
    Metric("PM2.5", "pm25", 60, DAILY, 15, DAILY, 1000.5),
    Metric("PM10", "pm10", 100, DAILY, 45, DAILY, 1000.5),
    Metric("NO2", "no2", 80, DAILY, 25, DAILY, 1000),
    Metric("SO2", "so2", 50, DAILY, 40, DAILY, 500),
    Metric("CO", "co", 2000, EIGHT_HOUR, 4000, DAILY, 100000),
    Metric("Ozone", "ozone", 100, EIGHT_HOUR, 100, EIGHT_HOUR, 1000),
))

# Unit prefix and the factor that brings it to the canonical unit.
UNIT_FACTORS = (("mg/m", 1000.0),)

# Readings that usually stand for "no measurement".
SENTINELS = (-999.0, -9999.0, -1.0)

RAW_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("state_name", T.StringType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("parameter_name", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("collected_at", T.TimestampNTZType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("source", T.StringType()),
])

# The delimited form of the raw readings, positional, everything text.
CSV_COLUMNS = ["station_id", "state_name", "city_name", "parameter_name",
               "unit", "collected_at", "value", "source"]
CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLUMNS])

# The pinned long layout.
LONG_COLUMNS = ["station_id", "collected_at", "year", "month", "day", "hour",
                "parameter_name", "reading", "state_name", "city_name", "source"]
