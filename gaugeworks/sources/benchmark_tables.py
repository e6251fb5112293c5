"""The provided star-schema tables seen as readings.

Two relations: ``event_readings`` (hourly, from events) and ``line_readings``
(daily, several metrics per line item, with genuine duplicates).  Gaps,
sentinels, missing units and missing cities are planted by id arithmetic over
every row, so the expected counts can be computed independently.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.timeparts import format_timestamp, hour_start
from gaugeworks.model import CSV_COLUMNS, DAILY, EIGHT_HOUR, Metric, MetricSpec

EVENT_SPEC = MetricSpec((
    Metric("click", "click", 60, DAILY, 15, DAILY, 1000.5),
    Metric("view", "view", 60, DAILY, 45, DAILY, 1000.5),
    Metric("purchase", "purchase", 60000, EIGHT_HOUR, 40000, DAILY, 1000000),
    Metric("error", "error", 60, EIGHT_HOUR, 100, EIGHT_HOUR, 300),
))

LINE_SPEC = MetricSpec((
    Metric("quantity", "quantity", 30, DAILY, 25, DAILY, 60),
    Metric("price", "price", 60000, DAILY, 50000, DAILY, 110000),
    Metric("discount", "discount", 0.12, EIGHT_HOUR, 0.1, DAILY, 1),
    Metric("tax", "tax", 0.12, EIGHT_HOUR, 0.1, EIGHT_HOUR, 1),
))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _offset(key: str):
    # Keeps the planted values off the two-decimal grid, where rounding ties are common.
    return (F.col(key) % 1009).cast("double") / F.lit(7919.0)


# Session setting: deal line items over so many partitions.  For sample files with one row
# group, which one task would read; unset, scans stay as they are.
SAMPLE_PARTITIONS = "gaugeworks.sample.partitions"


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Nation as city, region as state; every eleventh city is missing."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey",
                    F.when(F.col("n_nationkey") % 11 != 0, F.col("n_name")).alias("city_name"),
                    F.col("r_name").alias("state_name")))


def _located_events(spark: SparkSession, folder: str) -> DataFrame:
    customer = (table(spark, folder, "customer")
                .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    return (table(spark, folder, "events")
            .join(customer, F.col("user_id") == F.col("c_custkey"))
            .join(places(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")))


def event_readings(spark: SparkSession, folder: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``carry`` names columns of the events that are kept beside the readings."""
    key = F.col("event_id")
    return _located_events(spark, folder).select(
        *carry,
        F.col("user_id").alias("station_id"),
        F.col("c_name").alias("station_name"),
        "state_name", "city_name",
        F.col("event_type").alias("parameter_name"),
        F.when(F.col("event_type") == "purchase", "mg/m³")
         .when(key % 83 != 0, "µg/m³").alias("unit"),
        hour_start(F.col("ts")).alias("collected_at"),
        F.when(key % 89 == 0, F.lit(None).cast("double")).when(key % 97 == 0, -1.0)
         .otherwise(F.col("value") + _offset("event_id")).alias("value"),
        F.col("c_mktsegment").alias("source"))


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same events as raw delimited text, with every kind of ill-formed row planted."""
    key = F.col("event_id")
    value = (F.when(key % 89 == 0, "abc").when(key % 97 == 0, "-1.0")
             .when(key % 53 == 5, " 12.5 ").when(key % 59 == 7, "1e-05")
             .when(key % 61 == 9, ".5").when(key % 67 == 11, "").when(key % 71 == 13, "NaN")
             .otherwise(F.col("value").cast("decimal(18,2)").cast("string")))
    unit = (F.when(F.col("event_type") == "purchase", "mg/m³")
            .when(key % 83 == 0, "").otherwise("µg/m³"))
    at = F.when(key % 107 == 2, "").when(key % 113 == 4, "31.02.2024 at noon").otherwise(format_timestamp(hour_start(F.col("ts"))))
    parameter = (F.when(key % 109 == 3, " ").when(key % 73 == 6, F.concat(F.lit(" "), "event_type", F.lit(" ")))
                 .otherwise(F.col("event_type")))
    whole = F.concat_ws(",", F.col("user_id").cast("string"), "state_name",
                        F.coalesce("city_name", F.lit("")), parameter, unit, at, value,
                        "c_mktsegment")
    short = F.concat_ws(",", F.col("user_id").cast("string"), "state_name", parameter)
    return _located_events(spark, folder).select(
        F.when(key % 101 == 0, short).when(key % 103 == 1, ",".join(CSV_COLUMNS))
         .otherwise(whole).alias("line"))


def line_readings(spark: SparkSession, folder: str, partitions: int | None = None) -> DataFrame:
    lines = (table(spark, folder, "lineitem")
             .select("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_returnflag",
                     F.col("l_quantity").alias("quantity"),
                     F.col("l_extendedprice").alias("price"),
                     F.col("l_discount").alias("discount"),
                     F.when(F.col("l_linenumber") != 3, F.col("l_tax")).alias("tax")))
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    if partitions:
        lines = lines.repartition(partitions, "l_orderkey", "l_linenumber")
    located = (lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
               .join(places(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
               .select(F.col("l_suppkey").alias("station_id"), F.col("s_name").alias("station_name"),
                       "state_name", "city_name", F.col("l_shipdate").alias("collected_at"),
                       F.col("l_returnflag").alias("source"), "l_orderkey",
                       *LINE_SPEC.names))
    measures = F.inline(F.array(*[F.struct(F.lit(n).alias("parameter_name"),
                                           F.col(n).alias("measure")) for n in LINE_SPEC.names]))
    return (located.select("station_id", "station_name", "state_name", "city_name", "collected_at",
                           "source", "l_orderkey", measures)
            .where(F.col("measure").isNotNull())
            .select("station_id", "station_name", "state_name", "city_name", "parameter_name",
                    F.lit("µg/m³").alias("unit"), "collected_at",
                    (F.col("measure") + _offset("l_orderkey")).alias("value"), "source"))
