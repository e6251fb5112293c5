"""Averaging windows as a stateful stream: means are published once, when their window is over.

Two aggregates follow each other.  The first averages repeated readings of one reading key,
the second averages those over tumbling windows as long as the metric's averaging time (24
hours, 8 hours, ...), aligned to midnight.  Both keep their open groups in the state store
until the watermark (greatest time seen minus ``delay``) passes them; a reading behind the
watermark is dropped.  Published rows are appended and never change.  Every call drains what
is there and stops; the next one goes on from the checkpoint folder.

Naive local times are carried as if they were UTC, so no result depends on the session zone.
"""
from __future__ import annotations

from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.model import HOURS_PER_DAY, RAW_SCHEMA, MetricSpec
from gaugeworks.operators.clean import READING_KEY, kept_readings

DELAY = "2 days"
STATES_PER_CORE = 4
PLACE = ["station_id", "city_name", "state_name", "parameter_name"]
_DAY_SECONDS = HOURS_PER_DAY * 3600


def _event_time(at: Column) -> Column:
    """A naive time as the timestamp it would be in UTC, to the second."""
    days = F.unix_date(at.cast("date")).cast("long")
    return F.timestamp_seconds(days * _DAY_SECONDS + F.hour(at) * 3600 + F.minute(at) * 60
                               + F.floor(F.second(at)))


def _windows_of(readings: DataFrame, spec: MetricSpec, hours: int) -> DataFrame:
    """Means of all metrics with one averaging time."""
    names = [m.name for m in spec if m.hours == hours]
    cells = (readings.where(F.col("parameter_name").isin(names)).groupBy("at", *READING_KEY)
             .agg(F.avg("reading").alias("reading"), F.count("*").alias("rows")))
    means = cells.groupBy(F.window("at", f"{hours} hours").alias("w"), *PLACE).agg(
        F.avg("reading").alias("mean"), F.count("*").alias("hours"), F.sum("rows").alias("rows"))
    start = F.unix_seconds("w.start")
    block = F.floor(F.pmod(start, F.lit(_DAY_SECONDS)) / (hours * 3600)).cast("int")
    return means.select(
        *PLACE, F.date_from_unix_date(F.floor(start / _DAY_SECONDS).cast("int")).alias("date"),
        (F.lit(None).cast("int") if hours == HOURS_PER_DAY else block).alias("block"),
        "mean", "hours", "rows")


def stream_window_means(readings: DataFrame, spec: MetricSpec, delay: str = DELAY) -> DataFrame:
    """Windows of a streaming frame of kept readings; one branch per averaging time."""
    timed = readings.withColumn("at", _event_time(F.col("collected_at"))).withWatermark("at", delay)
    return reduce(DataFrame.unionByName, [
        _windows_of(timed, spec, hours) for hours in sorted({m.hours for m in spec}, reverse=True)])


def publish_windows(spark: SparkSession, source: str, target: str, checkpoint: str, spec: MetricSpec,
                    delay: str = DELAY, schema: T.StructType = RAW_SCHEMA,
                    max_files: int | None = None) -> StreamingQuery:
    """Append the windows that new Parquet files complete to ``target``, then stop.

    The sink's log makes each batch visible once and whole, so a load that breaks off is
    repeated from its checkpoint without loss or repetition.  ``max_files`` bounds a batch;
    the watermark advances between batches, so smaller batches find more rows late.
    """
    stream = spark.readStream.schema(schema)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    means = stream_window_means(kept_readings(stream.parquet(source), spec), spec, delay)
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(state_partitions(spark)))    # the stream takes the settings over as it starts
    try:
        return (means.writeStream.format("parquet").outputMode("append").option("path", target)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(setting, before)


def state_partitions(spark: SparkSession) -> int:
    """Parts of a new stream's state: a few per core, never more than the session's shuffle partitions.

    Adaptive execution does not merge parts of a state, and each is loaded and committed by
    every aggregate in every batch, whatever it holds.  A checkpoint folder keeps its number.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")),
               STATES_PER_CORE * spark.sparkContext.defaultParallelism)


def close_stream(spark: SparkSession, source: str, spec: MetricSpec, at: datetime,
                 schema: T.StructType = RAW_SCHEMA) -> None:
    """Add the reading that ends a stream: one per averaging time, at a time past all others.

    The watermark then passes every window before ``at`` minus the delay; the windows of the
    closing readings themselves stay open and are never published.
    """
    last = {m.hours: m.name for m in spec}
    ends = spark.createDataFrame(pa.table({
        "parameter_name": pa.array(last.values(), pa.string()),
        "collected_at": pa.array([at] * len(last), pa.timestamp("us")),
        "value": pa.array([0.0] * len(last), pa.float64())}))
    (ends.select(*[(F.col(f.name) if f.name in ends.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                   for f in schema]).coalesce(1).write.mode("append").parquet(source))


def published(spark: SparkSession, target: str) -> DataFrame:
    """The windows published so far."""
    return spark.read.parquet(target)


def late_readings(kept: DataFrame, windows: DataFrame) -> DataFrame:
    """Per metric: kept readings, those in published windows, and those in none.

    Exact once the stream is closed; before that, readings of open windows count as missing.
    ``kept`` is a batch read of the stream's source without its closing readings.
    """
    arrived = kept.groupBy("parameter_name").agg(F.count("*").alias("kept"))
    counted = windows.groupBy(F.col("parameter_name").alias("_metric")).agg(F.sum("rows").alias("n"))
    in_window = F.coalesce("n", F.lit(0))
    return arrived.join(counted, F.col("parameter_name") == F.col("_metric"), "left").select(
        F.col("parameter_name").alias("pollutant"), "kept", in_window.alias("published"),
        (F.col("kept") - in_window).alias("late"))
