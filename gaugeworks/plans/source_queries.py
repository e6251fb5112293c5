"""Queries over scans and sinks: what is written to a fresh folder must read back whole."""
from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.cleaning import lenient_number
from gaugeworks.functions.timeparts import format_timestamp
from gaugeworks.model import CSV_COLUMNS, LONG_COLUMNS
from gaugeworks.operators import summaries
from gaugeworks.plans.oracle import ev
from gaugeworks.plans.registry import query
from gaugeworks.plans.tables import EVENTS, Tables
from gaugeworks.session import fresh_path
from gaugeworks.sources import incremental, readers, writers


def _fresh_name(label: str) -> str:
    return f"gaugeworks_{label}_{uuid.uuid4().hex}"


def _bulk_tree(t: Tables) -> str:
    at = F.col("collected_at")
    rows = t.bulk_raw.select("*", F.year(at).alias("year"), F.month(at).alias("month"))
    return writers.write_tree(rows, fresh_path(t.spark, "tree"))


def _text_columns(t: Tables):
    """The readings in the eight-column text layout."""
    return t.raw.select(
        F.col("station_id").cast("string").alias("station_id"), "state_name", "city_name",
        "parameter_name", "unit", format_timestamp(F.col("collected_at")).alias("collected_at"),
        F.col("value").cast("string").alias("value"), "source")


_LONG_SCHEMA = T.StructType([
    T.StructField("station_id", T.LongType()), T.StructField("collected_at", T.TimestampNTZType()),
    T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()), T.StructField("hour", T.IntegerType()),
    T.StructField("parameter_name", T.StringType()), T.StructField("reading", T.DoubleType()),
    T.StructField("state_name", T.StringType()), T.StructField("city_name", T.StringType()),
    T.StructField("source", T.StringType())])

_LONG_SQL = """SELECT station_id, strftime(collected_at, '%Y-%m-%d %H:%M:%S') AS collected_at,
  year, month, day, hour, parameter_name, round(reading, 4) AS reading, state_name, city_name, source
  FROM clean"""

_SUMMARY_SQL = """SELECT city_name AS city, parameter_name AS pollutant, count(*) AS reading_count,
  round(avg(reading), 4) AS mean, round(min(reading), 4) AS min, round(max(reading), 4) AS max
  FROM kept GROUP BY ALL"""


@query("s1_partitioned_tree", """
SELECT CAST(year(collected_at) AS INTEGER) AS year, CAST(month(collected_at) AS INTEGER) AS month,
  parameter_name, count(*) AS rows, round(avg(value), 4) AS mean FROM l GROUP BY ALL""")
def _(t):
    tree = readers.read_tree(t.spark, _bulk_tree(t))
    return tree.groupBy("year", "month", "parameter_name").agg(
        F.count("*").alias("rows"), F.avg("value").alias("mean"))


@query("s2_month_selection", """
SELECT CAST(month(collected_at) AS INTEGER) AS month, count(*) AS rows,
  count(DISTINCT station_id) AS stations
FROM l WHERE month(collected_at) IN (1, 2, 3, 7) GROUP BY ALL""")
def _(t):
    tree = readers.read_tree(t.spark, _bulk_tree(t), months="1-3,7")
    return tree.groupBy("month").agg(F.count("*").alias("rows"),
                                     F.count_distinct("station_id").alias("stations"))


@query("s3_projected_scan", """
SELECT parameter_name, count(*) AS rows, round(max(value), 4) AS largest FROM l GROUP BY ALL""")
def _(t):
    tree = readers.read_tree(t.spark, _bulk_tree(t), columns=["parameter_name", "value"])
    return tree.groupBy("parameter_name").agg(F.count("*").alias("rows"),
                                              F.max("value").alias("largest"))


@query("s4_csv_parts", """
SELECT CAST(station_id AS VARCHAR) AS station_id, state_name, city_name, parameter_name, unit,
  strftime(collected_at, '%Y-%m-%d %H:%M:%S') AS collected_at, round(value, 4) AS value, source
FROM r""")
def _(t):
    path = writers.write_csv_parts(_text_columns(t), fresh_path(t.spark, "parts"), 5000)
    return (readers.read_csv_parts(t.spark, path)
            .withColumn("value", lenient_number(F.col("value"))))


@query("s5_malformed_rows", """
SELECT malformed, count(*) AS rows FROM t GROUP BY ALL""")
def _(t):
    path = fresh_path(t.spark, "lines")
    t.text_lines.write.text(path)
    rows = readers.split_lines(readers.read_lines(t.spark, path))
    return rows.groupBy("malformed").agg(F.count("*").alias("rows"))


@query("s6_embedded_delimiter", """
SELECT station_name || ', "' || state_name || '"' AS station_name, count(*) AS rows
FROM r GROUP BY ALL""")
def _(t):
    named = t.raw.select(F.concat("station_name", F.lit(', "'), "state_name", F.lit('"'))
                         .alias("station_name"), "value")
    path = writers.write_csv_parts(named, fresh_path(t.spark, "quoted"))
    schema = T.StructType([T.StructField("station_name", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    return (readers.read_csv_parts(t.spark, path, schema).groupBy("station_name")
            .agg(F.count("*").alias("rows")))


@query("s7_result_file", """
SELECT city_name, count(DISTINCT station_id) AS stations, count(*) AS readings,
  round(avg(reading), 4) AS click_avg, round(min(reading), 4) AS click_min,
  round(max(reading), 4) AS click_max
FROM clean WHERE parameter_name = 'click' GROUP BY city_name
HAVING count(DISTINCT station_id) >= 3""")
def _(t):
    result = summaries.city_ranking(t.clean, EVENTS, 3, top=None)
    path = writers.write_csv_parts(result, fresh_path(t.spark, "result"))
    return readers.read_csv_parts(t.spark, path, result.schema)


@query("s8_headerless_csv", _LONG_SQL)
def _(t):
    path = writers.write_headerless_csv(t.clean, fresh_path(t.spark, "long"), LONG_COLUMNS)
    return (readers.read_headerless_csv(t.spark, path, _LONG_SCHEMA)
            .withColumn("collected_at", format_timestamp(F.col("collected_at"))))


@query("s9_external_table", _SUMMARY_SQL)
def _(t):
    summary = summaries.city_metric_summary(t.kept)
    path = writers.write_headerless_csv(summary, fresh_path(t.spark, "tsv"), summary.columns, "\t")
    return readers.bind_external(t.spark, _fresh_name("city_metric"), path, summary.schema, "\t")


@query("s10_bounded_parts", """
SELECT count(*) AS rows, true AS bounded, true AS every_part_has_header FROM r""")
def _(t):
    path = writers.write_csv_parts(_text_columns(t), fresh_path(t.spark, "bounded"), 1000)
    files = readers.header_report(t.spark, path, CSV_COLUMNS)
    return files.agg(F.sum(F.col("lines") - F.col("header_lines")).alias("rows"),
                     F.bool_and(F.col("lines") <= 1001).alias("bounded"),
                     F.bool_and("conforms").alias("every_part_has_header"))


@query("s11_pinned_order", """
SELECT count(*) AS lines, count(*) AS lines_in_pinned_order FROM clean""")
def _(t):
    path = writers.write_headerless_csv(t.clean, fresh_path(t.spark, "pinned"), LONG_COLUMNS)
    field = lambda name: F.get(F.split("line", ",", -1), F.lit(LONG_COLUMNS.index(name)))
    # Calendar parts repeat the timestamp and metrics are known, so a shifted column shows.
    at = field("collected_at")
    in_order = (F.size(F.split("line", ",", -1)) == len(LONG_COLUMNS)) & field("parameter_name").isin(EVENTS.names)
    for name, start, length in (("year", 1, 4), ("month", 6, 2), ("day", 9, 2), ("hour", 12, 2)):
        in_order = in_order & (field(name).try_cast("int") == F.substring(at, start, length).try_cast("int"))
    in_order = in_order & field("station_id").rlike("^[0-9]+$") & field("reading").try_cast("double").isNotNull()
    return readers.read_lines(t.spark, path).agg(
        F.count("*").alias("lines"),
        F.count_if(in_order).alias("lines_in_pinned_order"))


@query("s12_overwrite_table", f"""
SELECT year, month, {ev("round(avg(CASE WHEN parameter_name = '{n}' THEN reading END), 4) AS {s}_avg")}
FROM clean GROUP BY year, month""")
def _(t):
    path = fresh_path(t.spark, "table")
    monthly = summaries.monthly_means(t.clean, EVENTS)
    name = _fresh_name("monthly")
    earlier = summaries.monthly_means(t.clean.where(F.col("hour") < 12), EVENTS)
    writers.write_table(earlier.withColumn("year", F.col("year") - 100), name, path)
    return writers.write_table(monthly, name, path)


@query("s13_overwrite_directory", f"""
SELECT hour, {ev("round(avg(CASE WHEN parameter_name = '{n}' THEN reading END), 4) AS {s}_avg")},
  count(*) AS readings FROM clean GROUP BY hour""")
def _(t):
    profile = summaries.hourly_profile(t.clean, EVENTS)
    path = fresh_path(t.spark, "directory")
    for _ in range(2):
        writers.write_headerless_csv(profile, path, profile.columns)
    return readers.read_headerless_csv(t.spark, path, profile.schema)


@query("s14_single_ordered_file", f"""
WITH s AS ({_SUMMARY_SQL}) SELECT count(*) AS groups, CAST(sum(reading_count) AS BIGINT) AS readings,
  CAST(1 AS BIGINT) AS files, true AS ordered FROM s""")
def _(t):
    summary = summaries.city_metric_summary(t.kept)
    path = writers.write_ordered_file(summary, fresh_path(t.spark, "ordered"),
                                      F.col("city"), F.col("pollutant"))
    rows = readers.read_csv_parts(t.spark, path, summary.schema).select(
        "*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    before = F.lag(F.struct("city", "pollutant")).over(Window.partitionBy("file").orderBy("line"))
    return (rows.withColumn("rises", F.coalesce(before < F.struct("city", "pollutant"), F.lit(True)))
            .agg(F.count("*").alias("groups"), F.sum("reading_count").alias("readings"),
                 F.count_distinct("file").alias("files"), F.bool_and("rises").alias("ordered")))


@query("s17_incremental_load", """
SELECT CAST(year(collected_at) AS INTEGER) AS year, CAST(month(collected_at) AS INTEGER) AS month,
  count(*) AS rows FROM l GROUP BY ALL""")
def _(t):
    target = fresh_path(t.spark, "incremental")
    source = readers.read_tree(t.spark, _bulk_tree(t))
    incremental.publish_missing(source.where(F.col("month") <= 6), target)
    incremental.publish_missing(source, target)
    return (t.spark.read.parquet(target).groupBy("year", "month")
            .agg(F.count("*").alias("rows")))


@query("s18_file_inventory", """
SELECT 'events.parquet' AS file, count(*) AS rows, true AS has_size FROM events
UNION ALL SELECT 'lineitem.parquet', count(*), true FROM lineitem
UNION ALL SELECT 'customer.parquet', count(*), true FROM customer""")
def _(t):
    files = None
    for name in ("events", "lineitem", "customer"):
        part = readers.file_inventory(t.table(name))
        files = part if files is None else files.unionByName(part)
    return files.groupBy(F.element_at(F.split("file_path", "/"), -1).alias("file")).agg(
        F.sum("rows").alias("rows"), F.bool_and(F.col("file_size") > 0).alias("has_size"))
