"""What is in a raw readings table, before any rule is decided."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import lenient_number
from gaugeworks.functions.statistics import percentage
from gaugeworks.functions.timeparts import day_of, format_timestamp
from gaugeworks.model import SENTINELS, MetricSpec
from gaugeworks.operators.quantiles import percentiles


def null_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing cells and their share per column, all columns in one pass."""
    columns = columns or df.columns
    counts = df.agg(F.count("*").alias("_total"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    return (counts.unpivot(["_total"], [f"`{c}`" for c in columns], "column", "nulls")
            .select("column", "nulls", percentage(F.col("nulls"), F.col("_total")).alias("null_pct")))


def metric_inventory(raw: DataFrame) -> DataFrame:
    """Rows, stations and share of rows per metric that occurs."""
    per_station = raw.groupBy("parameter_name", "station_id").agg(F.count("*").alias("n"))
    metrics = per_station.groupBy("parameter_name").agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("station_id").isNotNull()).alias("stations"))
    total = metrics.agg(F.sum("rows").alias("total")).scalar()
    return metrics.withColumn("share_pct", percentage(F.col("rows"), total))


def metric_presence(raw: DataFrame, spec: MetricSpec) -> DataFrame:
    """Each metric as 'analysed', 'missing' (specified, absent) or 'not analysed'."""
    seen = raw.select(F.col("parameter_name").alias("metric")).distinct()
    core = spec.frame(raw.sparkSession).select(F.col("pollutant").alias("metric"))
    return (core.join(seen, "metric", "left_semi").withColumn("status", F.lit("analysed"))
            .unionByName(core.join(seen, "metric", "left_anti")
                         .withColumn("status", F.lit("missing")))
            .unionByName(seen.join(F.broadcast(core), "metric", "left_anti")
                         .withColumn("status", F.lit("not analysed"))))


def unit_report(raw: DataFrame, listed: int | None = None) -> DataFrame:
    """Units per metric and whether they are mixed.

    All units are counted and named in alphabetical order.  Units are free text; where they are
    too many for one line, ``listed`` names the first ones only.
    """
    units = raw.where(F.col("unit").isNotNull()).select("parameter_name", "unit").distinct()
    counts = units.groupBy("parameter_name").agg(F.count("*").alias("distinct_units"))
    if listed is not None:
        place = F.row_number().over(Window.partitionBy("parameter_name").orderBy("unit"))
        units = units.withColumn("_place", place).where(F.col("_place") <= listed)
    named = units.groupBy("parameter_name").agg(
        F.concat_ws(", ", F.array_sort(F.collect_list("unit"))).alias("units"))
    return (named.join(counts, F.equal_null(named.parameter_name, counts.parameter_name))
            .select(named.parameter_name, "units", "distinct_units",
                    (F.col("distinct_units") > 1).alias("mixed")))


def value_sanity(raw: DataFrame, sentinels=SENTINELS) -> DataFrame:
    """Extremes, mean, zeros, negatives and hits of each suspected sentinel."""
    v = F.col("value")
    return raw.agg(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"),
                   F.count_if(v == 0).alias("zeros"), F.count_if(v < 0).alias("negatives"),
                   *[F.count_if(v == s).alias(f"hits_minus_{abs(s):g}") for s in sentinels])


def metric_ranges(raw: DataFrame) -> DataFrame:
    """Minimum, exact median and maximum per metric."""
    median = (percentiles(raw, "value", [0.5], ["parameter_name"])
              .select(F.col("parameter_name").alias("_p"), F.col("percentile").alias("median")))
    return (raw.groupBy("parameter_name").agg(F.min("value").alias("min"),
                                              F.max("value").alias("max"))
            .join(median, F.col("parameter_name").eqNullSafe(F.col("_p")), "left")
            .select("parameter_name", "min", "median", "max"))


def geography(raw: DataFrame) -> DataFrame:
    """Distinct stations, states, cities and sources; rows and stations without a city."""
    stations = raw.groupBy("station_id", "state_name", "city_name", "source").agg(
        F.count("*").alias("n"))
    nowhere = F.col("city_name").isNull()
    return stations.agg(
        F.count_distinct("station_id").alias("stations"),
        F.count_distinct("state_name").alias("states"),
        F.count_distinct("city_name").alias("cities"),
        F.count_distinct("source").alias("sources"),
        F.sum(F.when(nowhere, F.col("n")).otherwise(0)).alias("rows_without_city"),
        F.count_distinct(F.when(nowhere, F.col("station_id"))).alias("stations_without_city"))


def value_counts(raw: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per label, most frequent first."""
    counts = (raw.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count("*").alias("rows")))
    return counts if top is None else counts.orderBy(F.desc("rows"), column).limit(top)


def time_range(raw: DataFrame) -> DataFrame:
    return raw.agg(format_timestamp(F.min("collected_at")).alias("first_reading"),
                   format_timestamp(F.max("collected_at")).alias("last_reading"))


def grain_check(readings: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and rows beyond the first of their key."""
    per_key = readings.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count("*").alias("keys"),
                       F.sum(F.col("n") - 1).alias("duplicates"))


def duplicate_keys(readings: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once and how many rows they hold beyond the first."""
    return (readings.groupBy(*keys).agg((F.count("*") - 1).alias("extra_rows"))
            .where(F.col("extra_rows") > 0))


def completeness(raw: DataFrame, metric: str, expected: int = 24) -> DataFrame:
    """Station-days with a reading of one metric, readings per such day, and short days."""
    days = (raw.where(F.col("parameter_name") == metric)
            .groupBy("station_id", day_of(F.col("collected_at")).alias("date"))
            .agg(F.count("*").alias("n")))
    short = F.count_if(F.col("n") < expected)
    return days.agg(F.count("*").alias("station_days"), F.avg("n").alias("readings_per_day"),
                    short.alias("short_days"), percentage(short, F.count("*")).alias("short_pct"))


def parse_check(raw: DataFrame, column: str = "value") -> DataFrame:
    """How many text values hold a number, over every row."""
    number = lenient_number(F.col(column))
    return raw.agg(F.count("*").alias("rows"), F.count_if(number.isNotNull()).alias("numeric"),
                   F.count_if(number.isNull()).alias("not_numeric"))
