"""Mergeable summaries that are kept: count, sum, minimum and maximum per city, metric and month.

A table of readings laid out by year and month has a table of states laid out alike.  After a
load only the partitions whose files changed are read; the summary of everything, or of any
coarser group, is a merge of states and reads no reading.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.sources.incremental import PARTITIONS

GROUP = ("city_name", "parameter_name")


def partial_states(kept: DataFrame, by: tuple[str, ...] = (*PARTITIONS, *GROUP)) -> DataFrame:
    """One state per group; combined map-side, so the shuffle carries states."""
    return kept.groupBy(*by).agg(
        F.count("reading").alias("n"), F.sum("reading").alias("total"),
        F.min("reading").alias("low"), F.max("reading").alias("high"))


def merge_states(states: DataFrame, by: tuple[str, ...] = GROUP) -> DataFrame:
    """States of any finer grouping to states of a coarser one."""
    return states.where(F.col("n") > 0).groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"))


def finished(states: DataFrame) -> DataFrame:
    """The summary columns of merged states: count, mean, minimum, maximum."""
    groups = [F.col(c).alias({"city_name": "city", "parameter_name": "pollutant"}.get(c, c))
              for c in states.columns if c not in ("n", "total", "low", "high")]
    return states.select(*groups, F.col("n").alias("reading_count"),
                         F.coalesce(F.try_divide("total", "n"), F.lit(0.0)).alias("mean"),
                         F.col("low").alias("min"), F.col("high").alias("max"))


def partition_files(spark: SparkSession, root: str, keys: tuple[str, ...] = PARTITIONS) -> DataFrame:
    """Files, bytes and time of the last change per partition, from the file listing alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    return listed.groupBy(*keys).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("modified"))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _changes(spark: SparkSession, source: str, states: str, keys: tuple[str, ...]) -> list[tuple]:
    """Keys of changed partitions with the files, bytes and time (microseconds) they have now.

    One short row per partition that needs work reaches the driver, as with any listing.
    """
    marks = ["files", "bytes", "modified"]
    now = partition_files(spark, source, keys)
    seen = _stored(spark, f"{states}/inventory")
    if seen is None:
        changed = now
    else:
        old = seen.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(m).alias(f"_{m}") for m in marks])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        # A partition that is gone has no files; once that is noted, nothing more is to be done.
        both = now.join(old, same, "full").withColumn("files", F.coalesce("files", F.lit(0)))
        changed = (both.where(~reduce(Column.__and__, [F.col(m).eqNullSafe(F.col(f"_{m}")) for m in marks]))
                   .select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], *marks))
    rows = changed.select(*keys, "files", "bytes", F.unix_micros("modified")).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v) for v in r[:len(keys)]))


def stale_partitions(spark: SparkSession, source: str, states: str,
                     keys: tuple[str, ...] = PARTITIONS) -> list[tuple]:
    """Keys of source partitions that are new, changed or gone since their states were written."""
    return [r[:len(keys)] for r in _changes(spark, source, states, keys)]


def in_partitions(df: DataFrame, wanted: list[tuple], keys: tuple[str, ...] = PARTITIONS) -> DataFrame:
    """Rows of the listed partitions; the comparison with constants reaches the file listing."""
    if not wanted:
        return df.limit(0)
    any_of = [reduce(Column.__and__, [F.col(k).eqNullSafe(F.lit(v).cast(df.schema[k].dataType))
                                      for k, v in zip(keys, values)]) for values in wanted]
    return df.where(reduce(Column.__or__, any_of))


def refresh_states(spark: SparkSession, source: str, states: str,
                   clean: Callable[[DataFrame], DataFrame], keys: tuple[str, ...] = PARTITIONS) -> list[tuple]:
    """Bring the states below ``states`` up to date and tell which partitions were read.

    ``clean`` turns raw rows into kept readings and keeps the partition columns.  States are
    replaced partition by partition, then the inventory: a refresh that breaks off in between
    is repeated.  The inventory is the listing taken before anything was read, so files that
    arrive meanwhile are found changed by the next refresh.  A partition without kept readings, or gone from the source, gets one state
    with a count of zero.
    """
    changes = _changes(spark, source, states, keys)
    if not changes:
        return []
    stale = [r[:len(keys)] for r in changes]
    readings = in_partitions(spark.read.parquet(source), stale, keys)
    fresh = partial_states(clean(readings), (*keys, *GROUP))
    kinds = {k: readings.schema[k].dataType.simpleString() for k in keys}
    inventory = spark.createDataFrame(changes, ", ".join(
        [*(f"{k} {kinds[k]}" for k in keys), "files long", "bytes long", "modified long"]))
    empty = inventory.select(*keys, *[F.lit(None).cast(fresh.schema[c].dataType).alias(c) for c in GROUP],
                           F.lit(0).cast("long").alias("n"),
                           *[F.lit(None).cast("double").alias(c) for c in ("total", "low", "high")])

    def publish(df: DataFrame, name: str) -> None:
        # One small file per partition: a state table has a row per city and metric.
        (df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*keys).parquet(f"{states}/{name}"))

    publish(fresh.unionByName(empty), "states")
    publish(inventory.withColumn("modified", F.timestamp_micros("modified")), "inventory")
    return stale


def read_states(spark: SparkSession, states: str) -> DataFrame:
    """All states kept below a folder."""
    return spark.read.parquet(f"{states}/states")
