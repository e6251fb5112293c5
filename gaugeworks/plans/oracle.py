"""Shared relations of the checking SQL: the same readings, written independently."""
from __future__ import annotations

from gaugeworks.model import MetricSpec
from gaugeworks.sources.benchmark_tables import EVENT_SPEC, LINE_SPEC


def each(spec: MetricSpec, template: str, sep: str = ", ") -> str:
    """The template once per metric: {n} name, {s} short name, {c} wide column, {l} limit."""
    return sep.join(template.format(n=m.name, s=m.short, c=m.column, l=float(m.limit),
                                    w=m.window, g=float(m.guideline), gw=m.guideline_window,
                                    top=float(m.ceiling)) for m in spec)


def ev(template: str, sep: str = ", ") -> str:
    return each(EVENT_SPEC, template, sep)


def li(template: str, sep: str = ", ") -> str:
    return each(LINE_SPEC, template, sep)


_PARTS = ("CAST(year(collected_at) AS INTEGER) AS year, CAST(month(collected_at) AS INTEGER) AS month, "
          "CAST(day(collected_at) AS INTEGER) AS day, CAST(hour(collected_at) AS INTEGER) AS hour")


def _readings(raw: str, prefix: str, spec: MetricSpec) -> str:
    names = each(spec, "'{n}'")
    cells = each(spec, "avg(CASE WHEN parameter_name = '{n}' THEN reading END) AS {c}")
    return f"""
{prefix}kept AS (
  SELECT station_id, collected_at, parameter_name,
         value * CASE WHEN unit LIKE 'mg/m%' THEN 1000.0 ELSE 1.0 END AS reading,
         coalesce(nullif(trim(state_name), ''), 'Unknown') AS state_name,
         coalesce(nullif(trim(city_name), ''), 'Unknown') AS city_name, source
  FROM {raw} WHERE parameter_name IN ({names}) AND value >= 0 AND collected_at IS NOT NULL),
{prefix}clean AS (
  SELECT station_id, collected_at, {_PARTS}, parameter_name, avg(reading) AS reading,
         state_name, city_name, source
  FROM {prefix}kept
  GROUP BY station_id, collected_at, parameter_name, state_name, city_name, source),
{prefix}attrs AS (
  SELECT station_id, coalesce(max(nullif(state_name, 'Unknown')), 'Unknown') AS state_name,
         coalesce(max(nullif(city_name, 'Unknown')), 'Unknown') AS city_name,
         max(source) AS source
  FROM {prefix}kept GROUP BY station_id),
{prefix}cells AS (
  SELECT station_id, collected_at, {cells} FROM {prefix}clean GROUP BY station_id, collected_at),
{prefix}wide AS (
  SELECT c.*, {_PARTS}, state_name, city_name, source
  FROM {prefix}cells c LEFT JOIN {prefix}attrs USING (station_id)),
{prefix}days AS (
  SELECT station_id, CAST(collected_at AS DATE) AS date, {cells},
         max(state_name) AS state_name, max(city_name) AS city_name
  FROM {prefix}clean GROUP BY ALL)"""


_WINDOWS = """
windows AS (
  SELECT station_id, city_name, state_name, parameter_name AS pollutant,
         CAST(collected_at AS DATE) AS date,
         CASE WHEN parameter_name IN ('purchase', 'error') THEN hour // 8 END AS block,
         avg(reading) AS mean, count(*) AS hours
  FROM clean GROUP BY ALL),
limits AS (SELECT * FROM (VALUES {limits})
  t(metric_order, pollutant, standard_ug_m3, averaging_time, who_2021_ug_m3, who_averaging_time, ceiling)),
city_all AS (
  SELECT city_name, state_name, pollutant, any_value(standard_ug_m3) AS standard,
         count(mean) AS n, avg(mean) AS mean,
         count(*) FILTER (WHERE mean > standard_ug_m3) AS over,
         100.0 * count(*) FILTER (WHERE mean > standard_ug_m3) / count(mean) AS pct
  FROM windows JOIN limits USING (pollutant) GROUP BY city_name, state_name, pollutant),
city_exc AS (SELECT * FROM city_all WHERE n >= 30),
by_city AS (
  SELECT city_name, state_name, {cells} FROM city_exc GROUP BY city_name, state_name)"""


_SHARED = f"""
places AS (
  SELECT n_nationkey, CASE WHEN n_nationkey % 11 <> 0 THEN n_name END AS city_name,
         r_name AS state_name
  FROM nation JOIN region ON n_regionkey = r_regionkey),
located AS (
  SELECT * FROM events JOIN customer ON user_id = c_custkey
  JOIN places ON c_nationkey = n_nationkey),
r AS (
  SELECT user_id AS station_id, c_name AS station_name, state_name, city_name,
         event_type AS parameter_name,
         CASE WHEN event_type = 'purchase' THEN 'mg/m³'
              WHEN event_id % 83 = 0 THEN NULL ELSE 'µg/m³' END AS unit,
         date_trunc('hour', ts) AS collected_at,
         CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 97 = 0 THEN CAST(-1 AS DOUBLE)
              ELSE value + CAST(event_id % 1009 AS DOUBLE) / CAST(7919 AS DOUBLE) END AS value,
         c_mktsegment AS source
  FROM located),
lines AS (
  SELECT CASE WHEN event_id % 101 = 0
                THEN user_id || ',' || state_name || ',' || pname
              WHEN event_id % 103 = 1
                THEN 'station_id,state_name,city_name,parameter_name,unit,collected_at,value,source'
              ELSE user_id || ',' || state_name || ',' || coalesce(city_name, '') || ',' || pname
                || ',' || CASE WHEN event_type = 'purchase' THEN 'mg/m³'
                               WHEN event_id % 83 = 0 THEN '' ELSE 'µg/m³' END
                || ',' || CASE WHEN event_id % 107 = 2 THEN '' WHEN event_id % 113 = 4 THEN '31.02.2024 at noon'
                               ELSE strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') END
                || ',' || CASE WHEN event_id % 89 = 0 THEN 'abc' WHEN event_id % 97 = 0 THEN '-1.0'
                               WHEN event_id % 53 = 5 THEN ' 12.5 ' WHEN event_id % 59 = 7 THEN '1e-05'
                               WHEN event_id % 61 = 9 THEN '.5' WHEN event_id % 67 = 11 THEN ''
                               WHEN event_id % 71 = 13 THEN 'NaN'
                               ELSE CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) END
                || ',' || c_mktsegment END AS line
  FROM (SELECT *, CASE WHEN event_id % 109 = 3 THEN ' ' WHEN event_id % 73 = 6 THEN ' ' || event_type || ' '
                         ELSE event_type END AS pname FROM located)),
fields AS (SELECT string_split(line, ',') AS f FROM lines),
t AS (
  SELECT len(f) < 8 AS malformed, f[1] AS station_id, f[2] AS state_name, f[3] AS city_name,
         f[4] AS parameter_name, f[5] AS unit, f[6] AS collected_at, f[7] AS value, f[8] AS source,
         CASE WHEN isfinite(TRY_CAST(trim(f[7]) AS DOUBLE))
              THEN TRY_CAST(trim(f[7]) AS DOUBLE) END AS number
  FROM fields),
l AS (
  SELECT l_suppkey AS station_id, s_name AS station_name, state_name, city_name,
         parameter_name, 'µg/m³' AS unit, l_shipdate AS collected_at,
         measure + CAST(l_orderkey % 1009 AS DOUBLE) / CAST(7919 AS DOUBLE) AS value,
         l_returnflag AS source
  FROM (SELECT l_suppkey, l_orderkey, l_shipdate, l_returnflag, 'quantity' AS parameter_name,
               l_quantity AS measure FROM lineitem
        UNION ALL SELECT l_suppkey, l_orderkey, l_shipdate, l_returnflag, 'price',
               l_extendedprice FROM lineitem
        UNION ALL SELECT l_suppkey, l_orderkey, l_shipdate, l_returnflag, 'discount',
               l_discount FROM lineitem
        UNION ALL SELECT l_suppkey, l_orderkey, l_shipdate, l_returnflag, 'tax',
               l_tax FROM lineitem WHERE l_linenumber <> 3)
  JOIN supplier ON l_suppkey = s_suppkey JOIN places ON s_nationkey = n_nationkey),
{_readings('r', '', EVENT_SPEC)},
{_readings('l', 'l', LINE_SPEC)},
{_WINDOWS.format(
    limits=", ".join(f"({i}, '{m.name}', CAST({m.limit} AS DOUBLE), '{m.window}', "
                     f"CAST({m.guideline} AS DOUBLE), '{m.guideline_window}', "
                     f"CAST({m.ceiling} AS DOUBLE))" for i, m in enumerate(EVENT_SPEC)),
    cells=ev(", ".join(f"max(CASE WHEN pollutant = '{{n}}' THEN {c} END) AS {{n}}_{c}"
                       for c in ("n", "mean", "over", "pct"))))}
"""


def with_shared_relations(sql: str) -> str:
    """Put the shared relations in front of a query that may define some of its own."""
    sql = sql.strip()
    if sql.upper().startswith("WITH "):
        return f"WITH {_SHARED}, {sql[5:]}"
    return f"WITH {_SHARED} {sql}"
