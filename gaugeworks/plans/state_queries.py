"""Queries over what is kept between loads: streamed windows, mergeable states, sketches, layouts."""
from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from gaugeworks.operators import clean, comoments, reconcile, sketches, states, summaries
from gaugeworks.plans.oracle import li
from gaugeworks.plans.registry import query
from gaugeworks.plans.tables import EVENTS, LINES, Tables
from gaugeworks.session import fresh_path
from gaugeworks.sources import benchmark_tables as bench
from gaugeworks.sources import bucketed, incremental, readers, writers
from gaugeworks.streaming import windows

# ---- A24, A25: averaging windows as a stream

# Three loads of ten days each.  Some readings come with the third load: those of the first
# sixteen days are behind the watermark by then, those of the twentieth day are not.
_LATE = "event_id % 211 = 3 AND day <= 15"
_STRAGGLING = "event_id % 199 = 5 AND day = 19"


def _streamed(t: Tables):
    """(kept readings, published windows) after three loads and the end of the stream."""
    rows = bench.event_readings(t.spark, t.folder, carry=("event_id",))
    day = F.datediff(F.to_date("collected_at"), F.to_date(rows.agg(F.min("collected_at")).scalar()))
    load = F.expr(f"CASE WHEN ({_LATE}) OR ({_STRAGGLING}) THEN 2 ELSE least(day DIV 10, 2) END")
    arriving = t.staged(rows.withColumn("day", day).withColumn("load", load))
    source, target, checkpoint = (fresh_path(t.spark, f"stream-{name}") for name in ("in", "out", "log"))
    schema = rows.drop("event_id").schema

    def drain():
        windows.publish_windows(t.spark, source, target, checkpoint, EVENTS, schema=schema).awaitTermination()

    for n in range(3):
        arriving.where(F.col("load") == n).select(*schema.names).write.mode("append").parquet(source)
        drain()
    last = arriving.agg(F.max("collected_at").alias("at")).first()["at"]
    if last is not None:
        windows.close_stream(t.spark, source, EVENTS, last + timedelta(days=30), schema)
        drain()
    return clean.kept_readings(arriving, EVENTS), windows.published(t.spark, target)


_STREAM_SQL = f"""
WITH arrived AS (
  SELECT event_id, user_id AS station_id, event_type AS parameter_name, date_trunc('hour', ts) AS collected_at,
    value + CAST(event_id % 1009 AS DOUBLE) / CAST(7919 AS DOUBLE) AS value, state_name, city_name, c_mktsegment AS source,
    date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM located), CAST(ts AS DATE)) AS day
  FROM located WHERE event_type IN ('click', 'view', 'purchase', 'error') AND event_id % 89 <> 0 AND event_id % 97 <> 0),
arrived_cells AS (
  SELECT station_id, collected_at, parameter_name, coalesce(city_name, 'Unknown') AS city_name, state_name, source,
    avg(value * CASE WHEN parameter_name = 'purchase' THEN 1000.0 ELSE 1.0 END) AS reading, count(*) AS n
  FROM arrived WHERE value >= 0 AND NOT ({_LATE}) GROUP BY ALL)"""


@query("a24_a25_stream_windows", f"""{_STREAM_SQL}
SELECT station_id, city_name, state_name, parameter_name, CAST(collected_at AS DATE) AS date,
  CASE WHEN parameter_name IN ('purchase', 'error') THEN CAST(hour(collected_at) // 8 AS INTEGER) END AS block,
  round(avg(reading), 4) AS mean, count(*) AS hours, CAST(sum(n) AS BIGINT) AS rows FROM arrived_cells GROUP BY ALL""")
def _(t):
    return _streamed(t)[1]


@query("a24_stream_late_readings", f"""{_STREAM_SQL}
SELECT parameter_name AS pollutant, count(*) AS kept, count(*) FILTER (WHERE NOT ({_LATE})) AS published,
  count(*) FILTER (WHERE {_LATE}) AS late FROM arrived WHERE value >= 0 GROUP BY ALL""")
def _(t):
    kept, published = _streamed(t)
    return windows.late_readings(kept, published)


# ---- A13: states kept per month

def _monthly_tree(t: Tables, path: str, months) -> None:
    at = F.col("collected_at")
    rows = t.bulk_raw.select("*", F.year(at).alias("year"), F.month(at).alias("month"))
    incremental.publish_missing(rows.where(months), path)


def _kept_states(t: Tables):
    """States after half the months, then after the rest; the second refresh reads the rest only."""
    tree, kept = fresh_path(t.spark, "tree"), fresh_path(t.spark, "states")
    for months in (F.col("month") <= 6, F.lit(True)):
        _monthly_tree(t, tree, months)
        states.refresh_states(t.spark, tree, kept, lambda raw: clean.kept_readings(
            raw, LINES, padded=False, carry=incremental.PARTITIONS))
    return states.read_states(t.spark, kept)


@query("a13_summary_from_states", """
SELECT city_name AS city, parameter_name AS pollutant, count(reading) AS reading_count, round(avg(reading), 4) AS mean,
  round(min(reading), 4) AS min, round(max(reading), 4) AS max FROM lkept GROUP BY ALL""")
def _(t):
    return states.finished(states.merge_states(_kept_states(t)))


@query("a13_yearly_from_states", """
SELECT CAST(year(collected_at) AS INTEGER) AS year, parameter_name AS pollutant, count(reading) AS reading_count,
  round(avg(reading), 4) AS mean, round(min(reading), 4) AS min, round(max(reading), 4) AS max FROM lkept GROUP BY ALL""")
def _(t):
    return states.finished(states.merge_states(_kept_states(t), ("year", "parameter_name")))


# ---- D1 to D3: correlation at all levels from one table of stations

def _level_sql(level: str, state: str, city: str) -> str:
    return " UNION ALL ".join(f"""
SELECT '{level}' AS level, {state} AS state_name, {city} AS city_name, '{a.name}-{b.name}' AS pair,
  count(*) FILTER (WHERE {a.column} IS NOT NULL AND {b.column} IS NOT NULL) AS n,
  round(CASE WHEN isfinite(corr({a.column}, {b.column})) THEN corr({a.column}, {b.column}) END, 6) AS correlation
FROM lwide GROUP BY 1, 2, 3 HAVING n > 0""" for a, b in LINES.pairs())


_NO_PLACE = "CAST(NULL AS VARCHAR)"
_LEVELS_SQL = " UNION ALL ".join((_level_sql("network", _NO_PLACE, _NO_PLACE), _level_sql("state", "state_name", _NO_PLACE),
                                  _level_sql("city", "state_name", "city_name")))


@query("d2_correlation_levels", _LEVELS_SQL, digits=6)
def _(t):
    stations = comoments.pair_states(t.bulk_wide, LINES, ["station_id", "state_name", "city_name"])
    return comoments.correlation_levels(t.staged(stations))


@query("d2_correlation_levels_by_load", _LEVELS_SQL, digits=6)
def _(t):
    keys = ["station_id", "state_name", "city_name"]
    wide = t.staged(t.bulk_wide)
    early, late = (comoments.pair_states(wide.where(when), LINES, keys)
                   for when in (F.col("month") <= 6, F.col("month") > 6))
    return comoments.correlation_levels(t.staged(comoments.merge_pairwise(early, late, keys)))


# ---- A12, Q8: quantiles from sketches; A3, A21, U5: stations from sketches

_SHARES = {"median": 0.5, "p99": 0.99}


@query("a12_sketch_quantiles", f"""
SELECT city_name AS city, parameter_name AS pollutant, count(*) AS n, round(min(reading), 4) AS low,
  round(max(reading), 4) AS high, true AS median_within, true AS p99_within FROM lclean GROUP BY ALL""")
def _(t):
    readings = t.staged(t.bulk_table)
    merged = t.staged(sketches.merge_quantiles(sketches.quantile_states(readings)))
    found = t.staged(sketches.quantiles_of(merged, {"low": 0.0, "high": 1.0, **_SHARES}))
    errors = sketches.rank_errors(readings, found, _SHARES).drop("n")
    bound = sketches.rank_bound()
    return found.join(errors, list(sketches.CITY_METRIC)).select(
        F.col("city_name").alias("city"), F.col("parameter_name").alias("pollutant"), "n", "low", "high",
        *[(F.col(f"{q}_rank_error") <= bound).alias(f"{q}_within") for q in _SHARES])


@query("a3_stations_per_year", """
WITH s AS (SELECT DISTINCT CAST(year(collected_at) AS INTEGER) AS year, station_id FROM lkept)
SELECT year, count(*) AS stations, count(b.station_id) AS stayed
FROM s LEFT JOIN (SELECT year + 1 AS year, station_id FROM s) b USING (year, station_id) GROUP BY year""")
def _(t):
    months = t.bulk_kept.select("station_id", F.year("collected_at").alias("year"), F.month("collected_at").alias("month"))
    kept = t.staged(sketches.station_states(months))
    return sketches.stations_and_stayers(t.staged(sketches.merge_stations(kept)))


# ---- A1, A4, A6: all places in one pass

def _place_sql(level: str, state: str, city: str) -> str:
    return f"""SELECT '{level}' AS level, {state} AS state_name, {city} AS city_name,
  count(DISTINCT city_name || '|' || state_name) AS cities, count(DISTINCT station_id) AS stations, count(*) AS readings,
  {li("round(avg(CASE WHEN parameter_name = '{n}' THEN reading END), 4) AS {s}_avg")},
  round(min(CASE WHEN parameter_name = 'quantity' THEN reading END), 4) AS quantity_min,
  round(max(CASE WHEN parameter_name = 'quantity' THEN reading END), 4) AS quantity_max FROM lclean GROUP BY 1, 2, 3"""


@query("a4_a6_place_levels", " UNION ALL ".join((
    _place_sql("network", _NO_PLACE, _NO_PLACE), _place_sql("state", "state_name", _NO_PLACE),
    _place_sql("city", "state_name", "city_name"))))
def _(t):
    return summaries.place_levels(t.bulk_table, LINES)


# ---- J1, J3: joins of bucketed tables

def _bucketed(t: Tables, df, label: str, by: list[str]):
    path = fresh_path(t.spark, label)
    return bucketed.write_bucketed(df, "gaugeworks_" + path.rsplit("/", 1)[1].replace("-", "_"), path, by)


@query("j1_bucketed_attributes", f"""
SELECT station_id, collected_at, {li("round({c}, 4) AS {c}")}, a.state_name, a.city_name, a.source
FROM lcells JOIN lattrs a USING (station_id)""")
def _(t):
    cells = t.bulk_cells.select("station_id", "collected_at", *LINES.columns)
    stations = clean.station_attributes(t.bulk_kept)
    return bucketed.joined([_bucketed(t, cells, "cells", ["station_id"]),
                            _bucketed(t, stations, "stations", ["station_id"])], ["station_id"], "left")


@query("j3_bucketed_complete_cases", f"""
SELECT station_id, collected_at, {li("round({c}, 4) AS {c}")} FROM lcells WHERE {li("{c} IS NOT NULL", " AND ")}""")
def _(t):
    key = ["station_id", "collected_at"]
    cells = t.staged(t.bulk_cells.select(*key, *LINES.columns))
    return bucketed.joined([_bucketed(t, cells.select(*key, m.column).where(F.col(m.column).isNotNull()), m.short, key)
                            for m in LINES], key)


# ---- S2: months chosen by a relation

@query("s2_months_of_calendar", """
SELECT CAST(year(collected_at) AS INTEGER) AS year, CAST(month(collected_at) AS INTEGER) AS month, parameter_name,
  count(*) AS rows, round(avg(value), 4) AS mean FROM l
WHERE (year(collected_at), month(collected_at)) IN (
  SELECT (year(o_orderdate), month(o_orderdate)) FROM orders GROUP BY year(o_orderdate), month(o_orderdate)
  HAVING count(*) % 2 = 0) GROUP BY ALL""")
def _(t):
    tree = fresh_path(t.spark, "tree")
    at = F.col("collected_at")
    writers.write_tree(t.bulk_raw.select("*", F.year(at).alias("year"), F.month(at).alias("month")), tree)
    calendar = (t.table("orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
                .count().where("count % 2 = 0"))
    return (readers.read_tree_when(t.spark, tree, calendar, columns=["parameter_name", "value", "year", "month"])
            .groupBy("year", "month", "parameter_name").agg(F.count("*").alias("rows"), F.avg("value").alias("mean")))


# ---- J6, Q2: rows that differ between two tables

_RECONCILED = ["station_id", "collected_at", "parameter_name", "reading", "source"]


def _two_sides(t: Tables):
    """Clean readings, and the same with every reading of one station's busiest hour raised by one."""
    left = t.staged(t.bulk_table.select(*_RECONCILED))
    place = F.struct("collected_at", "station_id", "parameter_name", "source")
    changed = left.where(place == left.agg(F.max(place)).scalar()).withColumn("reading", F.col("reading") + 1)
    right = left.where(place != left.agg(F.max(place)).scalar()).unionByName(changed)
    months = {"station_id": F.col("station_id"), "month": F.trunc(F.col("collected_at").cast("date"), "month")}
    return left, right, months


_CHANGED_SQL = """
WITH m AS (SELECT max((collected_at, station_id, parameter_name, source)) AS place FROM lclean),
c AS (SELECT station_id, collected_at, parameter_name, reading, source FROM lclean, m
  WHERE (collected_at, station_id, parameter_name, source) = place)"""


@query("j6_differing_groups", f"""{_CHANGED_SQL}
SELECT c.station_id, CAST(date_trunc('month', c.collected_at) AS DATE) AS month, count(*) AS left_rows, count(*) AS right_rows
FROM c JOIN lclean l ON c.station_id = l.station_id AND date_trunc('month', c.collected_at) = date_trunc('month', l.collected_at)
GROUP BY ALL""")
def _(t):
    return reconcile.differing_groups(*_two_sides(t), _RECONCILED)


@query("j6_differing_rows", f"""{_CHANGED_SQL}
SELECT station_id, collected_at, parameter_name, round(reading, 4) AS reading, source, 'left' AS side, 1 AS surplus FROM c
UNION ALL SELECT station_id, collected_at, parameter_name, round(reading + 1, 4), source, 'right', 1 FROM c""")
def _(t):
    left, right, months = _two_sides(t)
    groups = t.staged(reconcile.differing_groups(left, right, months, _RECONCILED))
    return reconcile.differing_rows(left, right, groups, months, _RECONCILED)
