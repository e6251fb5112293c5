"""From raw readings to the clean long table, with every input row accounted for."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.cleaning import (finite, is_blank, lenient_number, or_unknown,
                                           to_canonical_unit)
from gaugeworks.functions.timeparts import parse_timestamp, time_parts
from gaugeworks.model import LONG_COLUMNS, UNIT_FACTORS, UNKNOWN, MetricSpec
from gaugeworks.operators.reshape import LOCATION, STATION_HOUR, located_hours, unpivot_wide

# The buckets of the row audit, in order of precedence.
# ``bad_timestamp`` is this library's own: text that is no timestamp would join unrelated
# readings under one missing time, so it is rejected, after all other rules.
BUCKETS = ("malformed", "header", "missing_timestamp", "missing_parameter", "non_core",
           "non_numeric", "negative", "bad_timestamp", "kept")

# What identifies a reading; calendar parts follow from the timestamp and stay out of the key.
READING_KEY = ["station_id", "collected_at", "parameter_name", "state_name", "city_name", "source"]


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def _field(df: DataFrame, column: str) -> Column:
    """A column without surrounding blanks, if it is text."""
    return F.trim(F.col(column)) if _is_text(df, column) else F.col(column)


def _time(df: DataFrame) -> Column:
    """The timestamp; NULL for text that is none."""
    at = _field(df, "collected_at")
    return parse_timestamp(at) if _is_text(df, "collected_at") else at


def _missing(df: DataFrame, column: str) -> Column:
    return is_blank(F.col(column)) if _is_text(df, column) else F.col(column).isNull()


def numeric_value(df: DataFrame, column: str = "value") -> Column:
    """The reading as a finite double, whether the column is text or number."""
    return lenient_number(F.col(column)) if _is_text(df, column) else finite(F.col(column))


def classify(raw: DataFrame, spec: MetricSpec) -> DataFrame:
    """Add ``bucket``: the first rule each row fails, or ``kept``."""
    value = numeric_value(raw)
    parameter = _field(raw, "parameter_name")
    rules = []
    if "malformed" in raw.columns:
        rules.append(("malformed", F.col("malformed")))
    if _is_text(raw, "station_id"):
        rules.append(("header", _field(raw, "station_id") == "station_id"))
    rules += [("missing_timestamp", _missing(raw, "collected_at")),
              ("missing_parameter", _missing(raw, "parameter_name")),
              ("non_core", ~parameter.isin(spec.names)),
              ("non_numeric", value.isNull()),
              ("negative", value < 0),
              ("bad_timestamp", _time(raw).isNull())]
    bucket = F.lit("kept")
    for label, failed in reversed(rules):
        bucket = F.when(failed, label).otherwise(bucket)
    return raw.withColumn("bucket", bucket)


def audit(raw: DataFrame, spec: MetricSpec) -> DataFrame:
    """Rows per bucket, empty buckets included, plus the overlay of kept rows without a city.

    One pass with a fixed number of counters: what is shuffled is one row per task.
    """
    kept_nowhere = (F.col("bucket") == "kept") & is_blank(F.col("city_name"))
    counters = [F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS]
    totals = classify(raw, spec).agg(*counters, F.count_if(kept_nowhere).alias("unknown_city"))
    return totals.unpivot([], [*BUCKETS, "unknown_city"], "bucket", "rows")


def reconcile(raw: DataFrame, spec: MetricSpec) -> DataFrame:
    """One row: do the buckets add up to the input, and does cleaning keep what the audit kept?"""
    bucket = F.col("bucket")
    counted = classify(raw, spec).agg(
        F.count("*").alias("input_rows"),
        *[F.count_if(bucket == b).alias(b) for b in BUCKETS])
    dropped = sum((F.col(b) for b in BUCKETS[:-1]), F.lit(0))
    kept = kept_readings(raw, spec).agg(F.count("*").alias("n")).scalar()
    return counted.select(
        "input_rows", dropped.cast("bigint").alias("dropped_rows"),
        F.col("kept").alias("kept_rows"),
        ((F.col("input_rows") - dropped == F.col("kept")) & (F.col("kept") == kept)).alias("reconciles"))


def kept_readings(raw: DataFrame, spec: MetricSpec, factors=UNIT_FACTORS,
                  padded: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Readings that pass every rule, located and (unless factors are empty) in one unit.

    The rules of ``classify``, written as plain conjuncts: on typed columns the
    value range reaches the file scan.  Each column is trimmed if it is text,
    here as there.  A source whose metric names are known to have no blanks around
    them can say ``padded=False``: then the metric list reaches the file scan, too.
    NaN sorts above infinity, so one upper bound excludes both.  ``carry`` names further
    columns to keep, such as those the source is partitioned by.
    """
    metric = _field(raw, "parameter_name") if padded else F.col("parameter_name")
    value = numeric_value(raw)
    ok = metric.isin(spec.names)
    if _is_text(raw, "value"):
        ok = ok & (value >= 0)
    else:
        value = F.col("value")
        ok = ok & (value >= 0) & (value < F.lit(float("inf")))
    if "malformed" in raw.columns:
        ok = ok & ~F.col("malformed")
    if _is_text(raw, "station_id"):
        ok = ok & F.coalesce(_field(raw, "station_id") != "station_id", F.lit(True))
    at = _time(raw)
    return raw.where(ok & at.isNotNull()).select(
        _field(raw, "station_id").alias("station_id"), at.alias("collected_at"),
        metric.alias("parameter_name"),
        to_canonical_unit(value, F.col("unit"), factors).alias("reading"),
        or_unknown(F.col("state_name")).alias("state_name"),
        or_unknown(F.col("city_name")).alias("city_name"), _field(raw, "source").alias("source"), *carry)


def average_duplicates(readings: DataFrame) -> DataFrame:
    """One row per reading key, holding the mean of its duplicates.

    Partial averages are formed before the shuffle, so a key repeated many
    times travels once per task.
    """
    return readings.groupBy(*READING_KEY).agg(F.avg("reading").alias("reading"))


def with_time_parts(readings: DataFrame) -> DataFrame:
    """The pinned eleven-column layout."""
    return readings.select("*", *time_parts(F.col("collected_at"))).select(*LONG_COLUMNS)


def clean_long(raw: DataFrame, spec: MetricSpec, factors=UNIT_FACTORS,
               padded: bool = True) -> DataFrame:
    """Raw readings to the clean long table, in one shuffle of readings.

    The form for analyses of some metrics: a filter on the metric passes below the
    shuffle, and with ``padded=False`` to the scan.  For the whole table see
    :func:`clean_table`.
    """
    return with_time_parts(average_duplicates(kept_readings(raw, spec, factors, padded)))


def clean_table(kept: DataFrame, spec: MetricSpec) -> DataFrame:
    """The same rows for all metrics at once, in one shuffle of station-hours.

    The metrics of an hour are averaged side by side and unfolded after the
    shuffle, which then carries each station, hour and location once.
    """
    return long_table(located_hours(kept, spec), spec)


def long_table(hours: DataFrame, spec: MetricSpec) -> DataFrame:
    """Located station-hours unfolded into the pinned long layout."""
    return with_time_parts(unpivot_wide(hours, spec, [*STATION_HOUR, *LOCATION]))


def station_attributes(readings: DataFrame) -> DataFrame:
    """One row per station: a known label wins over ``Unknown``, then the greatest one."""
    def settled(column: str) -> Column:
        known = F.max(F.nullif(F.col(column), F.lit(UNKNOWN)))
        return F.coalesce(known, F.lit(UNKNOWN)).alias(column)

    return readings.groupBy("station_id").agg(
        settled("state_name"), settled("city_name"), F.max("source").alias("source"))
