"""Queries over reshaping, joins, aggregates, correlation and exceedance."""
from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.functions.timeparts import format_timestamp
from gaugeworks.operators import checks, clean, correlate, exceed, profile, report, reshape, summaries
from gaugeworks.plans.oracle import ev, li
from gaugeworks.plans.registry import BY_SIZE, by_size_sql, query
from gaugeworks.plans.tables import EVENTS_AND_SILENT, EVENTS, LINES, MIN_HOURS

_WIDE_SQL = ("SELECT station_id, strftime(collected_at, '%Y-%m-%d %H:%M:%S') AS collected_at, "
             "year, month, day, hour, {cells}, state_name, city_name, source FROM {rel}")


def _stamped(df):
    return df.withColumn("collected_at", format_timestamp(F.col("collected_at")))


# ---- reshaping -------------------------------------------------------------------------------

@query("a15_average_duplicates", """
SELECT station_id, strftime(collected_at, '%Y-%m-%d %H:%M:%S') AS collected_at, year, month, day,
  hour, parameter_name, round(reading, 4) AS reading, state_name, city_name, source FROM lclean""")
def _(t):
    return _stamped(t.bulk_table)


@query("a16_pivot_mean", f"""
SELECT station_id, strftime(collected_at, '%Y-%m-%d') AS date, {li("round({c}, 4) AS {c}")} FROM lcells""")
def _(t):
    wide = t.bulk_cells
    return wide.select("station_id", F.col("collected_at").cast("date").cast("string").alias("date"),
                       *LINES.columns)


@query("a17_pivot_max", f"""
SELECT station_id, strftime(collected_at, '%Y-%m-%d') AS date, max(state_name) AS state_name,
  max(city_name) AS city_name,
  {li("round(max(CASE WHEN parameter_name = '{n}' THEN reading END), 4) AS {c}")}
FROM lkept GROUP BY ALL""")
def _(t):
    wide = reshape.pivot_max(t.bulk_kept, LINES)
    return wide.select("station_id", F.col("collected_at").cast("date").cast("string").alias("date"),
                       "state_name", "city_name", *LINES.columns)


@query("a19_station_attributes", "SELECT * FROM lattrs UNION ALL SELECT * FROM attrs")
def _(t):
    return clean.station_attributes(t.bulk_kept).unionByName(clean.station_attributes(t.kept))


@query("j1_attach_attributes", _WIDE_SQL.format(cells=ev("round({c}, 4) AS {c}"), rel="wide"))
def _(t):
    return _stamped(t.wide)


@query("j3_complete_cases", f"""
WITH {li("j_{s} AS (SELECT station_id, collected_at, max(reading) AS v FROM lkept WHERE parameter_name = '{n}' GROUP BY ALL)")}
SELECT station_id, strftime(collected_at, '%Y-%m-%d') AS date, {li("round(j_{s}.v, 4) AS {c}")}
FROM j_quantity JOIN j_price USING (station_id, collected_at)
JOIN j_discount USING (station_id, collected_at) JOIN j_tax USING (station_id, collected_at)""")
def _(t):
    wide = reshape.complete_cases(reshape.pivot_max(t.bulk_kept, LINES), LINES)
    return wide.select("station_id", F.col("collected_at").cast("date").cast("string").alias("date"),
                       *LINES.columns)


@query("u2_located_and_converted", f"""
SELECT city_name, state_name, parameter_name, count(*) AS rows, round(avg(reading), 4) AS mean
FROM kept GROUP BY ALL""")
def _(t):
    return t.kept.groupBy("city_name", "state_name", "parameter_name").agg(
        F.count("*").alias("rows"), F.avg("reading").alias("mean"))


# ---- joins -----------------------------------------------------------------------------------



@query("j2_full_outer_by_city", f"""
SELECT city_name, state_name, click_n, round(click_pct, 4) AS click_pct, purchase_n,
  round(purchase_pct, 4) AS purchase_pct
FROM (SELECT city_name, state_name, n AS click_n, pct AS click_pct FROM city_exc WHERE pollutant = 'click' AND pct > 15)
FULL JOIN (SELECT city_name, state_name, n AS purchase_n, pct AS purchase_pct FROM city_exc WHERE pollutant = 'purchase' AND pct > 15)
USING (city_name, state_name)""")
def _(t):
    high = exceed.city_exceedance(t.city_counts).where(
        (F.col("pct") > 15) & F.col("pollutant").isin("click", "purchase"))
    return exceed.exceedance_by_city(high, EVENTS).select(
        "city_name", "state_name", "click_n", "click_pct", "purchase_n", "purchase_pct")


@query("j4_limit_lookup", """
SELECT pollutant, standard_ug_m3, averaging_time, count(*) AS rows,
  count(*) FILTER (WHERE reading > standard_ug_m3) AS above
FROM clean JOIN limits ON parameter_name = pollutant GROUP BY ALL""")
def _(t):
    return (exceed.with_limits(t.clean, EVENTS)
            .groupBy("pollutant", "standard_ug_m3", "averaging_time")
            .agg(F.count("*").alias("rows"),
                 F.count_if(F.col("reading") > F.col("standard_ug_m3")).alias("above")))


_BY_CITY_CELLS = ev("{n}_n, round({n}_mean, 4) AS {n}_mean, {n}_over, round({n}_pct, 4) AS {n}_pct")
_GREATEST = f"greatest({ev('{n}_pct')})"


@query("j5_restrict_to_ranked", f"""
WITH ranked AS (SELECT city_name, state_name, {_GREATEST} AS worst_pct FROM by_city
  ORDER BY worst_pct DESC NULLS LAST, city_name, state_name LIMIT 15)
SELECT city_name, state_name, pollutant, n, round(mean, 4) AS mean, round(pct, 4) AS pct
FROM city_exc JOIN ranked USING (city_name, state_name)""")
def _(t):
    cities = exceed.city_exceedance(t.city_counts)
    ranked = exceed.worst_cities(exceed.exceedance_by_city(cities, EVENTS), EVENTS)
    return (cities.join(ranked.select("city_name", "state_name"), ["city_name", "state_name"],
                        "left_semi")
            .select("city_name", "state_name", "pollutant", "n", "mean", "pct"))


@query("j6_independent_counts", """
SELECT count(*) AS left_total, count(*) AS right_total, true AS agree,
  CAST(0 AS BIGINT) AS differing_groups FROM kept""")
def _(t):
    summary = summaries.city_metric_summary(t.kept)
    direct = clean.classify(t.raw, EVENTS).where(F.col("bucket") == "kept")
    other = (direct.groupBy(F.coalesce("city_name", F.lit("Unknown")).alias("city"),
                            F.col("parameter_name").alias("pollutant"))
             .agg(F.count("*").alias("reading_count")))
    differing = checks.counts_agree(summary, other, ["city", "pollutant"], "reading_count")
    return checks.totals_agree(summary, other, "reading_count").withColumn(
        "differing_groups", differing.agg(F.count("*").alias("n")).scalar())


@query("j7_reference_lookup", """
SELECT station_name, state_name, count(*) AS rows FROM r GROUP BY ALL""")
def _(t):
    return t.raw.groupBy("station_name", "state_name").agg(F.count("*").alias("rows"))


# ---- aggregates ------------------------------------------------------------------------------

_OVERVIEW = """
SELECT 'readings' AS metric, CAST(count(*) AS VARCHAR) AS value FROM {c}
UNION ALL SELECT 'distinct stations', CAST(count(DISTINCT station_id) AS VARCHAR) FROM {c}
UNION ALL SELECT 'distinct cities', CAST(count(DISTINCT city_name) AS VARCHAR) FROM {c}
UNION ALL SELECT 'distinct states', CAST(count(DISTINCT state_name) AS VARCHAR) FROM {c}
UNION ALL SELECT 'min timestamp', strftime(min(collected_at), '%Y-%m-%d %H:%M:%S') FROM {c}
UNION ALL SELECT 'max timestamp', strftime(max(collected_at), '%Y-%m-%d %H:%M:%S') FROM {c}
UNION ALL SELECT 'cities labelled Unknown', CAST(count(*) AS VARCHAR) FROM {c} WHERE city_name = 'Unknown'"""


@query("a1_corpus_overview", _OVERVIEW.format(c="clean"))
def _(t):
    return summaries.corpus_overview(t.clean)


@query("u1_typed_union", "SELECT * FROM (" + _OVERVIEW.format(c="clean") + ") UNION ALL "
       "SELECT * FROM (" + _OVERVIEW.format(c="lclean") + ")")
def _(t):
    return summaries.corpus_overview(t.clean).unionByName(summaries.corpus_overview(t.bulk_table))


@query("a2_overall_means", f"""
SELECT count(DISTINCT CASE WHEN parameter_name = 'click' THEN station_id END) AS stations_click,
  {ev("round(avg(CASE WHEN parameter_name = '{n}' THEN reading END), 4) AS {s}_avg")} FROM clean""")
def _(t):
    return summaries.overall_means(t.clean, EVENTS)


@query("a3_conditional_distinct", f"""
SELECT {ev("count(DISTINCT CASE WHEN parameter_name = '{n}' THEN station_id END) AS stations_{s}")}
FROM clean""")
def _(t):
    return summaries.stations_per_metric(t.clean, EVENTS)


def _city_sql(rel: str, metric: str, floor: int, tail: str = "") -> str:
    return f"""SELECT city_name, count(DISTINCT station_id) AS stations, count(*) AS readings,
  round(avg(reading), 4) AS {metric}_avg, round(min(reading), 4) AS {metric}_min,
  round(max(reading), 4) AS {metric}_max FROM {rel} WHERE parameter_name = '{metric}'
  GROUP BY city_name HAVING count(DISTINCT station_id) >= {floor} {tail}"""


@query("a4_city_ranking", _city_sql("clean", "click", 3, "ORDER BY avg(reading) DESC, city_name LIMIT 15"))
def _(t):
    return summaries.city_ranking(t.clean, EVENTS)


@query("a4_city_ranking_all", _city_sql("lclean", "quantity", 3))
def _(t):
    return summaries.city_ranking(t.bulk_clean, LINES, top=None)


@query("a5_floor_audit", f"""
WITH c AS (SELECT city_name, count(DISTINCT station_id) AS stations FROM clean
  WHERE parameter_name = 'click' GROUP BY city_name)
SELECT count(*) AS cities, count(*) FILTER (WHERE stations >= 5) AS kept,
  count(*) FILTER (WHERE stations < 5) AS excluded FROM c""")
def _(t):
    return summaries.floor_audit(t.clean, EVENTS, 5)


_STATE_AVG = ", ".join(f"round(avg(CASE WHEN parameter_name = '{n}' THEN reading END), 4) AS {n}_avg"
                       for n in ("click", "view", "purchase"))


@query("a6_state_ranking", f"""
SELECT state_name, count(DISTINCT city_name) AS cities, count(DISTINCT station_id) AS stations,
  {_STATE_AVG} FROM clean GROUP BY state_name ORDER BY click_avg DESC, state_name LIMIT 15""")
def _(t):
    return summaries.state_ranking(t.clean, EVENTS)


@query("a6_state_ranking_where_primary", """
SELECT state_name, count(DISTINCT city_name) AS cities, count(DISTINCT station_id) AS stations,
  round(avg(click_ug_m3), 4) AS click_avg, round(avg(view_ug_m3), 4) AS view_avg,
  round(avg(purchase_ug_m3), 4) AS purchase_avg
FROM wide WHERE click_ug_m3 IS NOT NULL GROUP BY state_name""")
def _(t):
    return summaries.state_ranking_where_primary(t.wide, EVENTS)


@query("a7_monthly_primary", """
SELECT year, month, round(avg(reading), 4) AS quantity_avg, count(*) AS readings FROM lclean
WHERE parameter_name = 'quantity' GROUP BY year, month ORDER BY year, month""")
def _(t):
    return summaries.monthly_primary(t.bulk_clean, LINES)


_MONTHLY = f"""SELECT year, month, {li("round(avg(CASE WHEN parameter_name = '{n}' THEN reading END), 4) AS {s}_avg")}
FROM lclean GROUP BY year, month"""


@query("a8_monthly_means", _MONTHLY)
def _(t):
    return summaries.monthly_means(t.bulk_table, LINES)


@query("o9_ordered_axes", f"""
WITH m AS ({_MONTHLY}) SELECT *, row_number() OVER (ORDER BY year, month) AS place FROM m""")
def _(t):
    from pyspark.sql import Window
    place = F.row_number().over(Window.orderBy("year", "month")).cast("bigint")
    return summaries.monthly_means(t.bulk_table, LINES).withColumn("place", place)


@query("a9_hourly_profile", f"""
SELECT hour, {ev("round(avg(CASE WHEN parameter_name = '{n}' THEN reading END), 4) AS {s}_avg")},
  count(*) AS readings FROM clean GROUP BY hour""")
def _(t):
    return summaries.hourly_profile(t.clean, EVENTS)


@query("a9_hourly_profile_where_primary", f"""
SELECT hour, {ev("round(avg({c}), 4) AS {s}_avg")}, count(*) AS readings FROM wide
WHERE click_ug_m3 IS NOT NULL GROUP BY hour""")
def _(t):
    return summaries.hourly_profile_where_primary(t.wide, EVENTS)


@query("a10_peak_and_trough", f"""
WITH p AS (SELECT parameter_name AS metric, hour, avg(reading) AS mean FROM clean GROUP BY ALL)
SELECT metric, CAST(arg_max(hour, mean) AS INTEGER) AS peak_hour, round(max(mean), 4) AS peak_mean,
  CAST(arg_min(hour, mean) AS INTEGER) AS trough_hour, round(min(mean), 4) AS trough_mean
FROM p GROUP BY metric""")
def _(t):
    return summaries.peak_and_trough(summaries.hourly_profile(t.clean, EVENTS), EVENTS)


def _population_sql(names: str) -> str:
    return f"""WITH names AS (SELECT unnest([{names}]) AS pollutant)
SELECT pollutant, count(reading) AS n, round(avg(reading), 4) AS mean_value,
  round(min(reading), 4) AS min_value, round(max(reading), 4) AS max_value,
  round(stddev_pop(reading), 4) AS stddev, {by_size_sql('var_pop(reading)')} AS variance
FROM names LEFT JOIN lclean ON parameter_name = pollutant GROUP BY pollutant"""


@query("a11_population_statistics", _population_sql(li("'{n}'")), variance=BY_SIZE)
def _(t):
    return summaries.population_statistics(t.bulk_table, LINES)


def _sample_sql(spec_rows: str) -> str:
    return f"""WITH v AS ({spec_rows})
SELECT pollutant, count(v) AS n, count(*) - count(v) AS missing, round(avg(v), 4) AS mean,
  round(median(v), 4) AS median, round(min(v), 4) AS min, round(max(v), 4) AS max,
  {by_size_sql('var_samp(v)')} AS variance, round(stddev_samp(v), 4) AS stddev FROM v GROUP BY pollutant"""


@query("a12_sample_statistics",
       _sample_sql(li("SELECT '{n}' AS pollutant, {c} AS v FROM lwide", " UNION ALL ")), variance=BY_SIZE)
def _(t):
    return summaries.sample_statistics(t.staged(t.bulk_cells.select(*LINES.columns)), LINES)


_SUMMARY = """SELECT city_name AS city, parameter_name AS pollutant, count({v}) AS reading_count,
  round(avg({v}), 4) AS mean, round(min({v}), 4) AS min, round(max({v}), 4) AS max FROM {rel} GROUP BY ALL"""


@query("a13_city_metric_summary", _SUMMARY.format(v="reading", rel="lkept"))
def _(t):
    return summaries.city_metric_summary(t.bulk_kept)


@query("a13_city_metric_summary_source_units", """
SELECT coalesce(city_name, 'Unknown') AS city, parameter_name AS pollutant,
  count(value) AS reading_count, round(avg(value), 4) AS mean, round(min(value), 4) AS min,
  round(max(value), 4) AS max
FROM r WHERE parameter_name IN ('click', 'view', 'purchase', 'error') AND value >= 0 GROUP BY ALL""")
def _(t):
    return summaries.city_metric_summary(clean.kept_readings(t.raw, EVENTS, factors=()))


@query("a13_city_metric_summary_text", """
SELECT coalesce(nullif(trim(city_name), ''), 'Unknown') AS city, trim(parameter_name) AS pollutant,
  count(*) AS reading_count,
  round(avg(number * CASE WHEN unit LIKE 'mg/m%' THEN 1000.0 ELSE 1.0 END), 2) AS mean,
  round(min(number * CASE WHEN unit LIKE 'mg/m%' THEN 1000.0 ELSE 1.0 END), 4) AS min,
  round(max(number * CASE WHEN unit LIKE 'mg/m%' THEN 1000.0 ELSE 1.0 END), 4) AS max
FROM t WHERE NOT malformed AND station_id <> 'station_id' AND TRY_CAST(trim(collected_at) AS TIMESTAMP) IS NOT NULL
  AND trim(parameter_name) IN ('click', 'view', 'purchase', 'error') AND number >= 0 GROUP BY ALL""",
       mean=2)
def _(t):
    return summaries.city_metric_summary(clean.kept_readings(t.text_rows, EVENTS))


@query("a14_summary_counters", """
SELECT count(*) AS readings, count(DISTINCT city_name || '|' || parameter_name) AS pairs FROM lkept""")
def _(t):
    return summaries.summary_counters(summaries.city_metric_summary(t.bulk_kept))


@query("a20_coverage", ev("""SELECT '{n}' AS pollutant, count({c}) AS present, count(*) - count({c}) AS missing,
  round(100.0 * (count(*) - count({c})) / count(*), 4) AS missing_pct FROM wide""", " UNION ALL "))
def _(t):
    return summaries.coverage(t.wide, EVENTS)


@query("a21_wide_distincts", """
SELECT count(*) AS station_hours, count(DISTINCT station_id) AS stations,
  count(DISTINCT city_name) AS cities, count(DISTINCT state_name) AS states,
  count(*) FILTER (WHERE city_name = 'Unknown') AS unknown_city_rows FROM wide""")
def _(t):
    return summaries.wide_distincts(t.wide)


def _features_sql(rel: str, each, digits: int = 4) -> str:
    first = each("{c}").split(", ")[0]
    return f"""SELECT station_id, max(state_name) AS state_name, max(city_name) AS city_name,
  count(*) AS n_hours, {each("round(avg({c}), 4) AS {s}_avg")}
FROM {rel} WHERE {first} IS NOT NULL GROUP BY station_id
HAVING count(*) >= {MIN_HOURS} AND {each("count({c}) > 0", " AND ")}"""


@query("a22_station_features", _features_sql("days", ev))
def _(t):
    return t.features


@query("a22_station_features_bulk", _features_sql("lwide", li))
def _(t):
    return t.bulk_features


@query("a23_feature_funnel", f"""
WITH s AS (SELECT station_id, count(*) >= {MIN_HOURS} AS enough, {ev("count({c}) > 0", " AND ")} AS every
  FROM days WHERE click_ug_m3 IS NOT NULL GROUP BY station_id)
SELECT 'stations with the primary metric' AS metric, count(*) AS value FROM s
UNION ALL SELECT 'stations with enough hours', count(*) FILTER (WHERE enough) FROM s
UNION ALL SELECT 'stations with all metrics', count(*) FILTER (WHERE every) FROM s
UNION ALL SELECT 'stations in feature table', count(*) FILTER (WHERE enough AND every) FROM s""")
def _(t):
    return summaries.feature_funnel(t.daily, EVENTS, MIN_HOURS)


@query("m1_complete_stations", f"""
SELECT station_id, n_hours, {ev("{s}_avg")} FROM ({_features_sql("days", ev)})""")
def _(t):
    from gaugeworks.operators.cluster import complete_stations
    every = summaries.station_features(t.daily, EVENTS, MIN_HOURS, require_all=False)
    return complete_stations(every, EVENTS.averages).select("station_id", "n_hours",
                                                            *EVENTS.averages)


# ---- exceedance ------------------------------------------------------------------------------

def _window_sql(kind: str) -> str:
    return f"""SELECT station_id, city_name, state_name, pollutant, strftime(date, '%Y-%m-%d') AS date,
  CAST(block AS INTEGER) AS block, round(mean, 4) AS mean, hours FROM windows WHERE block IS {kind}"""


def _windows(t):
    hours = reshape.merge_locations(t.hours, EVENTS)
    return (exceed.window_means(hours, EVENTS, attributes=t.attributes).drop("total")
            .withColumn("date", F.col("date").cast("string"))
            .withColumnRenamed("parameter_name", "pollutant"))


@query("a24_daily_means", f"SELECT * EXCLUDE (block) FROM ({_window_sql('NULL')})")
def _(t):
    return _windows(t).where(F.col("block").isNull()).drop("block")


@query("a25_block_means", _window_sql("NOT NULL"))
def _(t):
    return _windows(t).where(F.col("block").isNotNull())


@query("a26_city_exceedance", """
SELECT city_name, state_name, pollutant, standard, n, round(mean, 4) AS mean, over,
  round(pct, 4) AS pct FROM city_exc""")
def _(t):
    return exceed.city_exceedance(t.city_counts)


_NETWORK = """
WITH hourly AS (SELECT city_name, state_name, parameter_name AS pollutant, avg(reading) AS mean
  FROM clean GROUP BY ALL),
above AS (SELECT pollutant, count(*) FILTER (WHERE mean > standard_ug_m3) AS cities_with_mean_above
  FROM hourly JOIN limits USING (pollutant) GROUP BY ALL),
totals AS (SELECT pollutant, count(mean) AS observations,
    count(*) FILTER (WHERE mean > standard_ug_m3) AS exceedances
  FROM windows JOIN limits USING (pollutant) GROUP BY ALL),
worst AS (SELECT * FROM (SELECT pollutant, city_name, pct, row_number() OVER (
    PARTITION BY pollutant ORDER BY pct DESC, city_name, state_name) AS place FROM city_exc)
  WHERE place = 1),
network AS (SELECT pollutant, standard_ug_m3, averaging_time, who_2021_ug_m3, who_averaging_time, observations,
  CASE averaging_time WHEN '24-hour' THEN 'station-days' ELSE '8-hour blocks' END AS observation_unit,
  exceedances, round(100.0 * exceedances / observations, 4) AS pct_above, cities_with_mean_above,
  city_name AS worst_city, round(pct, 4) AS worst_city_pct_above
FROM limits JOIN totals USING (pollutant) JOIN above USING (pollutant) LEFT JOIN worst USING (pollutant))
"""


@query("a27_network_exceedance", f"""{_NETWORK} SELECT * FROM network
UNION ALL SELECT 'silent', 5.0, '1-hour', 4.0, '24-hour', 0, '1-hour blocks', 0, NULL, 0, NULL, NULL""")
def _(t):
    return exceed.network_exceedance(t.city_counts, EVENTS_AND_SILENT)


@query("r8_headline", f"""{_NETWORK}
SELECT pollutant, pct_above, cities_with_mean_above, worst_city, worst_city_pct_above FROM network""")
def _(t):
    return report.headline(exceed.network_exceedance(t.city_counts, EVENTS))


def _by_city(t):
    return exceed.exceedance_by_city(exceed.city_exceedance(t.city_counts), EVENTS)


@query("a28_exceedance_by_city", f"SELECT city_name, state_name, {_BY_CITY_CELLS} FROM by_city")
def _(t):
    return _by_city(t)


@query("a29_thresholds", """
SELECT pollutant, standard_ug_m3 AS naaqs_ug_m3, averaging_time AS naaqs_averaging_time,
  who_2021_ug_m3, who_averaging_time FROM limits
WHERE pollutant IN (SELECT parameter_name FROM r)""")
def _(t):
    return exceed.thresholds(t.raw, EVENTS)


@query("w6_worst_share", f"""
SELECT city_name, state_name, round({_GREATEST}, 4) AS worst_pct FROM by_city""")
def _(t):
    return exceed.with_worst_pct(_by_city(t), EVENTS).select("city_name", "state_name", "worst_pct")


@query("o4_worst_cities", f"""
SELECT city_name, state_name, {_BY_CITY_CELLS}, round({_GREATEST}, 4) AS worst_pct FROM by_city
ORDER BY {_GREATEST} DESC NULLS LAST, city_name, state_name LIMIT 15""")
def _(t):
    return exceed.worst_cities(_by_city(t), EVENTS)


@query("w5_main_offender", """
WITH o AS (SELECT city_name, state_name, pollutant, pct, row_number() OVER (
    PARTITION BY city_name, state_name ORDER BY pct DESC, metric_order) AS place
  FROM city_exc JOIN limits USING (pollutant))
SELECT city_name, state_name, pollutant AS main_offender FROM o WHERE place = 1""")
def _(t):
    return exceed.with_main_offender(_by_city(t), EVENTS).select(
        "city_name", "state_name", "main_offender")


_HIGHLIGHTS = """WITH x AS (SELECT * FROM city_exc WHERE pct > 0)
SELECT CAST(row_number() OVER (ORDER BY pct DESC, city_name, state_name, pollutant) AS INTEGER) AS rank,
  city_name, state_name, pollutant, standard, round(mean, 4) AS mean, round(pct, 4) AS pct,
  (SELECT count(*) FROM x) AS exceeding_pairs
FROM x ORDER BY rank LIMIT 20"""


@query("o5_exceedance_highlights", _HIGHLIGHTS)
def _(t):
    return exceed.exceedance_highlights(exceed.city_exceedance(t.city_counts))


@query("w1_rank_numbers", f"SELECT rank, city_name, pollutant FROM ({_HIGHLIGHTS})")
def _(t):
    return (exceed.exceedance_highlights(exceed.city_exceedance(t.city_counts))
            .select("rank", "city_name", "pollutant"))


@query("f22_exceeding_only", """
SELECT city_name, state_name, pollutant, over, round(pct, 4) AS pct FROM city_exc WHERE pct > 0""")
def _(t):
    return (exceed.city_exceedance(t.city_counts).where(F.col("pct") > 0)
            .select("city_name", "state_name", "pollutant", "over", "pct"))


# ---- sorting and top-k -----------------------------------------------------------------------

@query("o1_top_states", """
SELECT state_name, round(avg(reading), 4) AS quantity_avg, count(*) AS readings FROM lclean
WHERE parameter_name = 'quantity' GROUP BY state_name ORDER BY avg(reading) DESC, state_name LIMIT 3""")
def _(t):
    return (t.bulk_clean.where(F.col("parameter_name") == "quantity").groupBy("state_name")
            .agg(F.avg("reading").alias("quantity_avg"), F.count("*").alias("readings"))
            .orderBy(F.desc("quantity_avg"), "state_name").limit(3))


@query("o2_extreme_stations", f"""
WITH f AS ({_features_sql("days", ev)})
SELECT * FROM (SELECT *, 'cleanest' AS "end" FROM f ORDER BY click_avg, station_id LIMIT 10)
UNION ALL SELECT * FROM (SELECT *, 'dirtiest' AS "end" FROM f ORDER BY click_avg DESC, station_id LIMIT 10)""")
def _(t):
    return summaries.extreme_stations(t.features, EVENTS)


@query("o3_largest_then_ascending", f"""
WITH c AS ({_city_sql("clean", "click", 3)}) SELECT * FROM c ORDER BY click_avg DESC, city_name LIMIT 10""")
def _(t):
    return report.largest(summaries.city_ranking(t.clean, EVENTS, top=None), "click_avg", 10,
                          "city_name")


# ---- correlation -----------------------------------------------------------------------------

_PAIRS = [(a, b) for a, b in EVENTS.pairs()]


def _pairs_sql(rel: str, pairs) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a.name}-{b.name}' AS pair, round(CASE WHEN isfinite(corr({a.column}, {b.column})) "
        f"THEN corr({a.column}, {b.column}) END, 6) AS correlation FROM {rel}" for a, b in pairs)


@query("d1_pairwise_correlation", """
SELECT round(corr(click_ug_m3, view_ug_m3), 6) AS correlation,
  count(*) FILTER (WHERE click_ug_m3 IS NOT NULL AND view_ug_m3 IS NOT NULL) AS pairs FROM days""",
       digits=6)
def _(t):
    from gaugeworks.functions.statistics import pearson
    a, b = F.col("click_ug_m3"), F.col("view_ug_m3")
    return t.daily.agg(pearson(a, b).alias("correlation"),
                       F.count_if(a.isNotNull() & b.isNotNull()).alias("pairs"))


@query("d2_correlation_pairs", _pairs_sql("days", _PAIRS), digits=6)
def _(t):
    return correlate.correlation_pairs(t.daily, EVENTS)


@query("d2_correlation_pairs_hourly", _pairs_sql("wide", _PAIRS), digits=6)
def _(t):
    return correlate.correlation_pairs(t.wide, EVENTS)


@query("d2_correlation_pairs_bulk", _pairs_sql("lwide", LINES.pairs()), digits=6)
def _(t):
    return correlate.correlation_pairs(t.bulk_wide, LINES)


def _matrix_sql(rel: str, spec) -> str:
    def cell(a, b):
        return "CAST(1 AS DOUBLE)" if a is b else f"round(corr({a.column}, {b.column}), 6)"
    return " UNION ALL ".join(
        f"SELECT '{a.name}' AS metric, " + ", ".join(f"{cell(a, b)} AS {b.name}" for b in spec)
        + f" FROM {rel}" for a in spec)


@query("d3_correlation_matrix", _matrix_sql("days", EVENTS), digits=6)
def _(t):
    return correlate.correlation_matrix(t.daily, EVENTS)


@query("r6_heat_map", _matrix_sql("lwide", LINES), digits=6)
def _(t):
    return correlate.correlation_matrix(t.bulk_wide, LINES)


@query("o7_strongest_pairs", f"""
WITH p AS ({_pairs_sql("days", _PAIRS)})
SELECT * FROM (SELECT *, 'positive' AS "end" FROM p ORDER BY correlation DESC, pair LIMIT 5)
UNION ALL SELECT * FROM (SELECT *, 'negative' AS "end" FROM p ORDER BY correlation, pair LIMIT 3)""",
       digits=6)
def _(t):
    return correlate.strongest_pairs(correlate.correlation_pairs(t.daily, EVENTS))


# ---- report relations ------------------------------------------------------------------------

@query("r1_top_cities", f"""
WITH c AS ({_city_sql("clean", "click", 3)})
SELECT *, least(20, (SELECT count(*) FROM c)) || ' of ' || (SELECT count(*) FROM c) AS label
FROM c ORDER BY click_avg DESC, city_name LIMIT 20""")
def _(t):
    return report.top_cities(summaries.city_ranking(t.clean, EVENTS, top=None), EVENTS)


@query("r2_monthly_series", """
SELECT year, month, strftime(make_date(year, month, 1), '%b') AS label,
  round(avg(reading), 4) AS quantity_avg FROM lclean WHERE parameter_name = 'quantity' GROUP BY year, month""")
def _(t):
    return report.monthly_series(summaries.monthly_means(t.bulk_table, LINES), LINES)


@query("r3_daily_cycle", """
SELECT hour, printf('%02d:00', hour) AS label,
  round(avg(CASE WHEN parameter_name = 'click' THEN reading END), 4) AS click_avg,
  round(avg(CASE WHEN parameter_name = 'purchase' THEN reading END), 4) AS purchase_avg
FROM clean GROUP BY hour""")
def _(t):
    return report.hour_labels(summaries.hourly_profile(t.clean, EVENTS), "click_avg", "purchase_avg")


@query("r4_density_histogram", """
WITH cut AS (SELECT parameter_name, quantile_cont(reading, 0.99) AS q FROM lclean GROUP BY ALL),
x AS (SELECT parameter_name, reading FROM lclean JOIN cut USING (parameter_name) WHERE reading <= q),
shape AS (SELECT parameter_name, min(reading) AS lo, count(*) AS total,
  (max(reading) - min(reading)) / CAST(60 AS DOUBLE) AS width FROM x GROUP BY ALL),
placed AS (SELECT parameter_name, CAST(least(floor((reading - lo) / width), 59) AS INTEGER) AS bin, count(*) AS n
  FROM x JOIN shape USING (parameter_name) GROUP BY ALL)
SELECT parameter_name, CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * width, 4) AS left_edge,
  coalesce(n, 0) AS n, round(coalesce(n, 0) / (total * width), 6) AS density
FROM shape CROSS JOIN (SELECT unnest(range(60)) AS bin) b
LEFT JOIN placed USING (parameter_name, bin)""", density=6)
def _(t):
    return report.density_histogram(
        t.staged(t.bulk_table.select("parameter_name", "reading")), LINES)


@query("r5_deviation_bands", """
SELECT parameter_name AS pollutant, round(avg(reading), 4) AS mean,
  round(avg(reading) + stddev_pop(reading), 4) AS upper, round(max(reading), 4) AS max
FROM lclean GROUP BY ALL""")
def _(t):
    return report.deviation_bands(summaries.population_statistics(t.bulk_table, LINES))


@query("w2_relative_change", """
WITH m AS (SELECT year * 100 + month AS period, avg(reading) AS price_avg FROM lclean
  WHERE parameter_name = 'price' GROUP BY ALL)
SELECT CAST(period AS INTEGER) AS period, round(price_avg, 4) AS price_avg,
  round(abs(price_avg - lag(price_avg) OVER (ORDER BY period)) / price_avg, 4) AS relative_change FROM m""")
def _(t):
    monthly = summaries.monthly_means(t.bulk_table, LINES).select(
        (F.col("year") * 100 + F.col("month")).alias("period"), "price_avg")
    return report.relative_change(monthly, "period", "price_avg")


@query("w4_bar_heights", """
WITH h AS (SELECT hour, avg(reading) AS click_avg FROM clean WHERE parameter_name = 'click' GROUP BY hour)
SELECT hour, round(click_avg, 4) AS click_avg,
  round(greatest(2, 100.0 * click_avg / (SELECT max(click_avg) FROM h)), 4) AS height FROM h""")
def _(t):
    profile = summaries.hourly_profile(t.clean, EVENTS).select("hour", "click_avg")
    return report.bar_heights(profile, "click_avg")
