"""Queries over filters, projections and cleaning rules, row audit and profiling."""
from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import (finite, is_blank, is_strict_number, lenient_number,
                                           or_unknown, strict_number, to_canonical_unit)
from gaugeworks.functions.statistics import over_limit, percentage
from gaugeworks.functions.timeparts import (block_of_day, day_of, format_timestamp,
                                            parse_timestamp, text_time_parts, time_parts)
from gaugeworks.operators import checks, clean, correlate, profile, report, reshape, summaries
from gaugeworks.plans.oracle import ev, li
from gaugeworks.plans.registry import query
from gaugeworks.plans.tables import EVENTS, LINES
from gaugeworks.sources import readers
from gaugeworks.session import fresh_path

_STAMP = "strftime(collected_at, '%Y-%m-%d %H:%M:%S')"


@query("f1_header_rows", """
SELECT state_name, count(*) AS rows FROM t
WHERE NOT malformed AND trim(station_id) <> 'station_id' GROUP BY ALL""")
def _(t):
    return (t.text_rows.where(~F.col("malformed") & (F.trim("station_id") != "station_id"))
            .groupBy("state_name").agg(F.count("*").alias("rows")))


@query("f2_strict_number", r"""
SELECT value, coalesce(regexp_matches(value, '^-?[0-9]+(\.[0-9]+)?$'), false) AS strict,
  round(CASE WHEN regexp_matches(value, '^-?[0-9]+(\.[0-9]+)?$') THEN CAST(value AS DOUBLE) END, 4) AS number,
  count(*) AS rows FROM (SELECT value FROM t WHERE NOT malformed AND station_id <> 'station_id') GROUP BY ALL""")
def _(t):
    rows = t.text_rows.where(~F.col("malformed") & (F.col("station_id") != "station_id"))
    return (rows.groupBy("value").agg(F.count("*").alias("rows"))
            .select("value", is_strict_number(F.col("value")).alias("strict"),
                    strict_number(F.col("value")).alias("number"), "rows"))


@query("f3_lenient_number", """
SELECT value, round(any_value(number), 5) AS number, count(*) AS rows FROM t
WHERE NOT malformed AND station_id <> 'station_id' GROUP BY value""", digits=5)
def _(t):
    rows = t.text_rows.where(~F.col("malformed") & (F.col("station_id") != "station_id"))
    return (rows.groupBy("value").agg(F.count("*").alias("rows"))
            .withColumn("number", lenient_number(F.col("value"))))


@query("f4_plausible_values", """
SELECT parameter_name, count(*) AS rows, round(min(value), 4) AS least FROM r
WHERE value >= 0 GROUP BY ALL""")
def _(t):
    return (t.raw.where(finite(F.col("value")) >= 0).groupBy("parameter_name")
            .agg(F.count("*").alias("rows"), F.min("value").alias("least")))


@query("f5_core_metrics", f"""
SELECT parameter_name, source, count(*) AS rows FROM r
WHERE parameter_name IN ({ev("'{n}'")}) GROUP BY ALL""")
def _(t):
    return (t.raw.where(F.col("parameter_name").isin(EVENTS.names))
            .groupBy("parameter_name", "source").agg(F.count("*").alias("rows")))


@query("f6_unknown_location", """
SELECT coalesce(nullif(trim(city_name), ''), 'Unknown') AS city_name,
  coalesce(nullif(trim(state_name), ''), 'Unknown') AS state_name, count(*) AS rows
FROM t WHERE NOT malformed AND station_id <> 'station_id' GROUP BY ALL""")
def _(t):
    rows = t.text_rows.where(~F.col("malformed") & (F.col("station_id") != "station_id"))
    return (rows.groupBy(or_unknown(F.col("city_name")).alias("city_name"),
                         or_unknown(F.col("state_name")).alias("state_name"))
            .agg(F.count("*").alias("rows")))


@query("f7_missing_keys", """
SELECT trim(collected_at) = '' AS no_timestamp, trim(parameter_name) = '' AS no_metric,
  count(*) AS rows FROM t WHERE NOT malformed GROUP BY ALL""")
def _(t):
    return (t.text_rows.where(~F.col("malformed"))
            .groupBy(is_blank(F.col("collected_at")).alias("no_timestamp"),
                     is_blank(F.col("parameter_name")).alias("no_metric"))
            .agg(F.count("*").alias("rows")))


@query("f8_trimmed_fields", """
SELECT trim(value) AS value, trim(parameter_name) AS parameter_name, count(*) AS rows
FROM t WHERE value <> trim(value) OR parameter_name <> trim(parameter_name) GROUP BY ALL""")
def _(t):
    value, name = F.col("value"), F.col("parameter_name")
    return (t.text_rows.where((value != F.trim(value)) | (name != F.trim(name)))
            .groupBy(F.trim(value).alias("value"), F.trim(name).alias("parameter_name"))
            .agg(F.count("*").alias("rows")))


@query("f9_unit_normalisation", f"""
SELECT station_id, {_STAMP} AS collected_at, parameter_name, unit, round(value, 4) AS value,
  round(value * CASE WHEN unit LIKE 'mg/m%' THEN 1000.0 ELSE 1.0 END, 4) AS converted FROM r""")
def _(t):
    return t.raw.select("station_id", format_timestamp(F.col("collected_at")).alias("collected_at"),
                        "parameter_name", "unit", "value",
                        to_canonical_unit(F.col("value"), F.col("unit")).alias("converted"))


@query("f10_time_parts", """
SELECT CAST(year(collected_at) AS INTEGER) AS year, CAST(month(collected_at) AS INTEGER) AS month,
  CAST(day(collected_at) AS INTEGER) AS day, CAST(hour(collected_at) AS INTEGER) AS hour,
  count(*) AS rows, true AS text_agrees FROM r GROUP BY ALL""")
def _(t):
    text = t.raw.withColumn("_text", format_timestamp(F.col("collected_at")))
    both = text.select(*time_parts(F.col("collected_at")),
                       F.struct(*text_time_parts(F.col("_text"))).alias("cut"))
    same = F.col("cut") == F.struct("year", "month", "day", "hour")
    return both.groupBy("year", "month", "day", "hour").agg(
        F.count("*").alias("rows"), F.bool_and(same).alias("text_agrees"))


@query("f11_parse_timestamps", """
SELECT TRY_CAST(nullif(collected_at, '') AS TIMESTAMP) IS NOT NULL AS parsed,
  CASE WHEN TRY_CAST(nullif(collected_at, '') AS TIMESTAMP) IS NOT NULL
       THEN strftime(CAST(collected_at AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') END AS stamp,
  count(*) AS rows FROM t GROUP BY ALL""")
def _(t):
    at = parse_timestamp(F.col("collected_at"))
    return (t.text_rows.groupBy(at.isNotNull().alias("parsed"), format_timestamp(at).alias("stamp"))
            .agg(F.count("*").alias("rows")))


@query("f12_date_key", """
SELECT strftime(collected_at, '%Y-%m-%d') AS date, count(*) AS rows FROM r GROUP BY ALL""")
def _(t):
    return (t.raw.groupBy(day_of(F.col("collected_at")).cast("string").alias("date"))
            .agg(F.count("*").alias("rows")))


@query("f13_eight_hour_block", """
SELECT CAST(hour(collected_at) // 8 AS INTEGER) AS block, CAST(min(hour(collected_at)) AS INTEGER) AS first_hour,
  CAST(max(hour(collected_at)) AS INTEGER) AS last_hour, count(*) AS rows FROM r GROUP BY 1""")
def _(t):
    at = F.col("collected_at")
    return t.raw.groupBy(block_of_day(at).alias("block")).agg(
        F.min(F.hour(at)).alias("first_hour"), F.max(F.hour(at)).alias("last_hour"),
        F.count("*").alias("rows"))


@query("f14_drop_incomplete", """
SELECT station_id, strftime(date, '%Y-%m-%d') AS date, round(click_ug_m3, 4) AS click_ug_m3,
  round(view_ug_m3, 4) AS view_ug_m3 FROM days
WHERE click_ug_m3 IS NOT NULL AND view_ug_m3 IS NOT NULL""")
def _(t):
    return (t.daily.na.drop(subset=["click_ug_m3", "view_ug_m3"])
            .select("station_id", F.col("date").cast("string").alias("date"),
                    "click_ug_m3", "view_ug_m3"))


@query("f15_metric_filter", f"""
SELECT station_id, {_STAMP} AS collected_at, round(value, 4) AS value FROM r
WHERE parameter_name = 'view'""")
def _(t):
    return (t.raw.where(F.col("parameter_name") == "view")
            .select("station_id", format_timestamp(F.col("collected_at")).alias("collected_at"),
                    "value"))


@query("f16_metric_columns", f"""
SELECT station_id, strftime(date, '%Y-%m-%d') AS date, {ev("round({c}, 4) AS {n}")} FROM days""")
def _(t):
    return (reshape.rename_metrics(t.daily, EVENTS)
            .select("station_id", F.col("date").cast("string").alias("date"), *EVENTS.names))


@query("f17_pinned_projection", """
SELECT station_id, parameter_name, city_name, CAST(NULL AS DOUBLE) AS humidity, count(*) AS rows
FROM r GROUP BY ALL""")
def _(t):
    pinned = reshape.pin_columns(
        t.raw, ["station_id", "parameter_name", "city_name", "humidity"], numeric=["humidity"])
    return pinned.groupBy(*pinned.columns).agg(F.count("*").alias("rows"))


@query("f18_literal_columns", """
SELECT 'readings' AS relation, parameter_name, CAST(1 AS INTEGER) AS version, count(*) AS rows
FROM clean GROUP BY ALL""")
def _(t):
    return (t.clean.withColumns({"relation": F.lit("readings"), "version": F.lit(1)})
            .groupBy("relation", "parameter_name", "version").agg(F.count("*").alias("rows")))


@query("f19_threshold_test", """
SELECT station_id, coalesce(click_ug_m3 > 60, false) AS click_over, count(*) AS days
FROM days GROUP BY ALL""")
def _(t):
    return (t.daily.groupBy("station_id", over_limit(F.col("click_ug_m3"), F.lit(60.0))
                            .alias("click_over")).agg(F.count("*").alias("days")))


@query("f20_guarded_percentage", """
SELECT city_name, count(click_ug_m3) AS n,
  round(100.0 * count(*) FILTER (WHERE click_ug_m3 > 300) / nullif(count(click_ug_m3) FILTER (WHERE click_ug_m3 > 100), 0), 4) AS pct
FROM days GROUP BY city_name""")
def _(t):
    v = F.col("click_ug_m3")
    return t.daily.groupBy("city_name").agg(
        F.count(v).alias("n"),
        percentage(F.count_if(v > 300), F.count_if(v > 100)).alias("pct"))


@query("f21_upper_trim", """
WITH cut AS (SELECT parameter_name, quantile_cont(reading, 0.99) AS q FROM lclean GROUP BY ALL)
SELECT parameter_name, count(*) AS rows, round(max(reading), 4) AS largest, round(avg(reading), 4) AS mean
FROM lclean JOIN cut USING (parameter_name) WHERE reading <= q GROUP BY ALL""")
def _(t):
    readings = t.staged(t.bulk_table.select("parameter_name", "reading"))
    return (report.trim_upper(readings, LINES).groupBy("parameter_name")
            .agg(F.count("*").alias("rows"), F.max("reading").alias("largest"),
                 F.avg("reading").alias("mean")))


# ---- row audit -------------------------------------------------------------------------------

_BUCKETS = f"""
  CASE WHEN malformed THEN 'malformed' WHEN trim(station_id) = 'station_id' THEN 'header'
       WHEN trim(collected_at) = '' THEN 'missing_timestamp'
       WHEN trim(parameter_name) = '' THEN 'missing_parameter'
       WHEN trim(parameter_name) NOT IN ({ev("'{n}'")}) THEN 'non_core'
       WHEN number IS NULL THEN 'non_numeric' WHEN number < 0 THEN 'negative'
       WHEN TRY_CAST(trim(collected_at) AS TIMESTAMP) IS NULL THEN 'bad_timestamp' ELSE 'kept' END"""


@query("q1_row_audit", f"""
WITH b AS (SELECT {_BUCKETS} AS bucket, city_name FROM t),
names AS (SELECT unnest(['malformed', 'header', 'missing_timestamp', 'bad_timestamp', 'missing_parameter', 'non_core',
  'non_numeric', 'negative', 'kept']) AS bucket)
SELECT bucket, count(b.bucket) AS rows FROM names LEFT JOIN b USING (bucket) GROUP BY bucket
UNION ALL SELECT 'unknown_city', count(*) FROM b WHERE bucket = 'kept' AND trim(city_name) = ''""")
def _(t):
    return clean.audit(t.text_rows, EVENTS)


@query("q2_reconciliation", f"""
WITH b AS (SELECT {_BUCKETS} AS bucket FROM t)
SELECT count(*) AS input_rows, count(*) FILTER (WHERE bucket <> 'kept') AS dropped_rows,
  count(*) FILTER (WHERE bucket = 'kept') AS kept_rows, true AS reconciles FROM b""")
def _(t):
    return clean.reconcile(t.text_rows, EVENTS)


_RAW_COLUMNS = ["station_id", "station_name", "state_name", "city_name", "parameter_name", "unit",
                "collected_at", "value", "source"]


@query("q3_null_report", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls,
    round(100.0 * (count(*) - count({c})) / count(*), 4) AS null_pct FROM r""" for c in _RAW_COLUMNS))
def _(t):
    return profile.null_report(t.raw)


@query("q4_metric_inventory", """
SELECT parameter_name, count(*) AS rows, count(DISTINCT station_id) AS stations,
  round(100.0 * count(*) / (SELECT count(*) FROM r), 4) AS share_pct FROM r GROUP BY ALL""")
def _(t):
    return profile.metric_inventory(t.raw)


@query("u4_metric_presence", f"""
WITH core AS (SELECT unnest([{ev("'{n}'")}]) AS metric),
seen AS (SELECT DISTINCT parameter_name AS metric FROM r)
SELECT metric, 'analysed' AS status FROM core WHERE metric IN (SELECT metric FROM seen)
UNION ALL SELECT metric, 'missing' FROM core WHERE metric NOT IN (SELECT metric FROM seen)
UNION ALL SELECT metric, 'not analysed' FROM seen WHERE metric NOT IN (SELECT metric FROM core)""")
def _(t):
    return profile.metric_presence(t.raw, EVENTS)


@query("q6_units", """
SELECT parameter_name, string_agg(DISTINCT unit, ', ' ORDER BY unit) AS units,
  count(DISTINCT unit) AS distinct_units, count(DISTINCT unit) > 1 AS mixed
FROM (SELECT parameter_name, unit FROM r WHERE unit IS NOT NULL
      UNION ALL SELECT 'any', unit FROM r WHERE unit IS NOT NULL) GROUP BY ALL""")
def _(t):
    return profile.unit_report(t.raw.select("parameter_name", "unit").unionByName(
        t.raw.select(F.lit("any").alias("parameter_name"), "unit")))


@query("q7_value_sanity", """
SELECT round(min(value), 4) AS min, round(max(value), 4) AS max, round(avg(value), 4) AS mean,
  count(*) FILTER (WHERE value = 0) AS zeros, count(*) FILTER (WHERE value < 0) AS negatives,
  count(*) FILTER (WHERE value = -999) AS hits_minus_999,
  count(*) FILTER (WHERE value = -9999) AS hits_minus_9999,
  count(*) FILTER (WHERE value = -1) AS hits_minus_1 FROM r""")
def _(t):
    return profile.value_sanity(t.raw)


@query("q8_metric_ranges", """
SELECT parameter_name, round(min(value), 4) AS min, round(quantile_cont(value, 0.5), 4) AS median,
  round(max(value), 4) AS max FROM r GROUP BY ALL""")
def _(t):
    return profile.metric_ranges(t.raw)


@query("q9_geography", """
SELECT count(DISTINCT station_id) AS stations, count(DISTINCT state_name) AS states,
  count(DISTINCT city_name) AS cities, count(DISTINCT source) AS sources,
  count(*) FILTER (WHERE city_name IS NULL) AS rows_without_city,
  count(DISTINCT CASE WHEN city_name IS NULL THEN station_id END) AS stations_without_city FROM r""")
def _(t):
    return profile.geography(t.raw)


@query("q10_time_range", """
SELECT strftime(min(collected_at), '%Y-%m-%d %H:%M:%S') AS first_reading,
  strftime(max(collected_at), '%Y-%m-%d %H:%M:%S') AS last_reading FROM l""")
def _(t):
    return profile.time_range(t.bulk_raw)


@query("q11_pivot_grain", """
WITH k AS (SELECT station_id, collected_at, parameter_name, count(*) AS n FROM l GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM k""")
def _(t):
    return profile.grain_check(t.bulk_raw, ["station_id", "collected_at", "parameter_name"])


@query("w3_duplicate_keys", """
SELECT station_id, strftime(collected_at, '%Y-%m-%d') AS date, parameter_name,
  count(*) - 1 AS extra_rows FROM l GROUP BY ALL HAVING count(*) > 1""")
def _(t):
    return (profile.duplicate_keys(t.bulk_raw, ["station_id", "collected_at", "parameter_name"])
            .select("station_id", day_of(F.col("collected_at")).cast("string").alias("date"),
                    "parameter_name", "extra_rows"))


@query("q12_completeness", """
WITH d AS (SELECT station_id, CAST(collected_at AS DATE) AS date, count(*) AS n FROM r
           WHERE parameter_name = 'click' GROUP BY ALL)
SELECT count(*) AS station_days, round(avg(n), 4) AS readings_per_day,
  count(*) FILTER (WHERE n < 24) AS short_days,
  round(100.0 * count(*) FILTER (WHERE n < 24) / count(*), 4) AS short_pct FROM d""")
def _(t):
    return profile.completeness(t.raw, "click")


@query("q13_reference_nulls", """
WITH s AS (SELECT c_custkey AS station_id, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS latitude,
  city_name FROM customer JOIN places ON c_nationkey = n_nationkey)
SELECT 'station_id' AS "column", count(*) - count(station_id) AS nulls, round(100.0 * (count(*) - count(station_id)) / count(*), 4) AS null_pct FROM s
UNION ALL SELECT 'latitude', count(*) - count(latitude), round(100.0 * (count(*) - count(latitude)) / count(*), 4) FROM s
UNION ALL SELECT 'city_name', count(*) - count(city_name), round(100.0 * (count(*) - count(city_name)) / count(*), 4) FROM s""")
def _(t):
    from gaugeworks.sources.benchmark_tables import places
    stations = t.table("customer").join(places(t.spark, t.folder),
                                        F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("station_id"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("latitude"), "city_name")
    return profile.null_report(stations)


@query("q14_header_conformance", """
SELECT count(*) AS rows, true AS every_file_conforms FROM r""")
def _(t):
    from gaugeworks.plans.source_queries import _text_columns
    from gaugeworks.sources import writers
    path = writers.write_csv_parts(_text_columns(t), fresh_path(t.spark, "headers"))
    return readers.header_report(t.spark, path).agg(
        F.sum(F.col("lines") - F.col("header_lines")).alias("rows"),
        F.bool_and("conforms").alias("every_file_conforms"))


@query("q15_parse_check", """
SELECT count(*) AS rows, count(number) AS numeric, count(*) - count(number) AS not_numeric FROM t""")
def _(t):
    return profile.parse_check(t.text_rows)


@query("q16_reshape_preserved", f"""
SELECT CAST({ev("count({c})", " + ")} AS BIGINT) AS wide_cells, (SELECT count(*) FROM clean) AS long_rows,
  {ev("count({c})", " + ")} = (SELECT count(*) FROM clean) AS preserved FROM wide""")
def _(t):
    return checks.reshape_preserved(t.clean, t.wide, EVENTS)


@query("q17_matrix_checks", """
SELECT CAST(16 AS BIGINT) AS cells, true AS symmetric, true AS unit_diagonal,
  (SELECT count(*) > 0 FROM days) AS in_range""")
def _(t):
    return checks.matrix_checks(correlate.correlation_cells(t.daily, EVENTS))


@query("q18_plausibility", """
SELECT pollutant, ceiling, round(min(reading), 4) AS min, round(max(reading), 4) AS max,
  count(*) FILTER (WHERE reading < 0) AS negative,
  count(*) FILTER (WHERE reading > ceiling) AS above_ceiling,
  count(*) FILTER (WHERE reading < 0 OR reading > ceiling) = 0 AS plausible
FROM clean JOIN limits ON parameter_name = pollutant GROUP BY ALL""")
def _(t):
    return checks.plausibility(t.clean, EVENTS)


@query("q20_conversion_check", """
SELECT count(*) AS rows, count(*) FILTER (WHERE parameter_name = 'purchase') AS metric_rows,
  count(*) FILTER (WHERE parameter_name = 'purchase' AND reading > 50) AS converted_rows,
  count(*) FILTER (WHERE month IS NULL) AS rows_without_month FROM clean""")
def _(t):
    return checks.conversion_check(t.clean, "purchase", 50.0)


@query("o8_top_labels", """
SELECT state_name, count(*) AS rows FROM r WHERE state_name IS NOT NULL
GROUP BY ALL ORDER BY rows DESC, state_name LIMIT 8""")
def _(t):
    return profile.value_counts(t.raw, "state_name", 8)


@query("u5_distinct_stations", """
SELECT count(DISTINCT station_id) AS stations, count(*) AS rows, count(DISTINCT source) AS labels
FROM (SELECT station_id, source FROM r UNION ALL SELECT station_id, source FROM l)""")
def _(t):
    both = t.raw.select("station_id", "source").unionByName(
        t.bulk_raw.select("station_id", "source"))
    per_station = both.groupBy("station_id", "source").agg(F.count("*").alias("n"))
    return per_station.agg(F.count_distinct("station_id").alias("stations"),
                           F.sum("n").alias("rows"), F.count_distinct("source").alias("labels"))
