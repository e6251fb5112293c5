"""Hand-made frames with answers fixed by hand."""
from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import (is_strict_number, lenient_number, or_unknown,
                                           strict_number, to_canonical_unit)
from gaugeworks.functions.statistics import pearson
from gaugeworks.functions.timeparts import (block_of_day, day_of, format_timestamp, hour_start,
                                            parse_timestamp)
from gaugeworks.model import AIR_QUALITY, CSV_COLUMNS, DAILY, Metric, MetricSpec
from gaugeworks.operators import (checks, clean, correlate, exceed, profile, quantiles, report,
                                  reshape, summaries)
from gaugeworks.sources.readers import parse_months, split_lines

TWO = MetricSpec((Metric("a", "a", 10, DAILY, 1, DAILY, 100),
                  Metric("b", "b", 10, "8-hour", 1, DAILY, 100)))


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def readings(spark, rows):
    """(station, 'yyyy-mm-dd hh:mm', metric, reading[, city]) to the clean long layout."""
    full = [(r[0], dt.datetime.strptime(r[1], "%Y-%m-%d %H:%M"), r[2], float(r[3]),
             "S", r[4] if len(r) > 4 else "C", "src") for r in rows]
    df = spark.createDataFrame(full, "station_id string, collected_at timestamp_ntz, "
                               "parameter_name string, reading double, state_name string, "
                               "city_name string, source string")
    return clean.with_time_parts(df)


def test_number_syntax(spark):
    texts = ["1", "-1", ".5", " 1.5 ", "1e-05", "abc", "", None, "NaN", "Infinity", "1.5d"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.orderBy("i").select(is_strict_number(F.col("t")).alias("s"),
                                  strict_number(F.col("t")).alias("v"),
                                  lenient_number(F.col("t")).alias("n")).collect()
    assert [r.s for r in rows] == [True, True] + [False] * 9
    assert [r.v for r in rows] == [1.0, -1.0] + [None] * 9
    assert [r.n for r in rows] == [1.0, -1.0, 0.5, 1.5, 1e-05, None, None, None, None, None, 1.5]


def test_units(spark):
    units = ["mg/m³", "mg/m3", "µg/m³", "ug/m3", "mg", None]
    df = spark.createDataFrame([(i, u, 2.0) for i, u in enumerate(units)], "i int, u string, v double")
    out = df.orderBy("i").select(to_canonical_unit(F.col("v"), F.col("u")).alias("x"))
    assert [r.x for r in out.collect()] == [2000.0, 2000.0, 2.0, 2.0, 2.0, 2.0]


def test_missing_locations(spark):
    labels = ["", None, " ", "Delhi"]
    df = spark.createDataFrame([(c, s) for c in labels for s in labels], "c string, s string")
    out = values(df.select(or_unknown(F.col("c")).alias("c"), or_unknown(F.col("s")).alias("s")),
                 "c", "s")
    assert len(out) == 16
    assert out.count(("Unknown", "Unknown")) == 9 and out.count(("Delhi", "Delhi")) == 1


def test_midnight_and_blocks(spark):
    times = ["2024-03-31 23:30", "2024-04-01 00:00", "2024-04-01 00:30", "2024-04-01 07:59",
             "2024-04-01 08:00", "2024-04-01 15:59", "2024-04-01 16:00"]
    df = spark.createDataFrame([(dt.datetime.strptime(t, "%Y-%m-%d %H:%M"),) for t in times],
                               "t timestamp_ntz").orderBy("t")
    out = df.select(day_of(F.col("t")).cast("string").alias("d"),
                    block_of_day(F.col("t")).alias("b"),
                    format_timestamp(hour_start(F.col("t"))).alias("h")).collect()
    assert [r.d for r in out] == ["2024-03-31"] + ["2024-04-01"] * 6
    assert [r.b for r in out] == [2, 0, 0, 0, 1, 1, 2]
    assert out[2].h == "2024-04-01 00:00:00" and out[0].h == "2024-03-31 23:00:00"


def test_hours_do_not_follow_the_session_time_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there
    try:
        row = df.select(hour_start(F.col("t")).alias("h"), F.hour("t").alias("hour")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.h == dt.datetime(2024, 3, 10, 2) and row.hour == 2


def test_bad_timestamps_become_null(spark):
    texts = ["2024-01-02 03:04:05", "2024-01-02", "2024-13-02 03:04:05", "", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r.p for r in df.select(parse_timestamp(F.col("t")).alias("p")).collect()]
    assert out == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None, None, None]


def test_months():
    assert parse_months("1-12") == list(range(1, 13))
    assert parse_months("3,1,2,1") == [1, 2, 3] and parse_months("7") == [7]
    for bad in ("0", "13", "1-13"):
        with pytest.raises(ValueError):
            parse_months(bad)


def test_audit_precedence(spark):
    good = "s,st,ci,PM2.5,u,2024-01-01 00:00:00,1,x"
    lines = [good, "s,st", ",".join(CSV_COLUMNS), "s,st,ci,PM2.5,u,,1,x", "s,st,ci, ,u,2024,1,x",
             "s,st,ci,Benzene,u,2024,abc,x", "s,st,ci,CO,u,2024,abc,x", "s,st,ci,CO,u,2024,-1,x",
             "s,st,,CO,u,2024-01-01 00:00:00,0,x", "s,st,ci,,u,,-1,x", good + ",extra"]
    raw = split_lines(spark.createDataFrame([(x,) for x in lines], "line string"))
    counts = dict(values(clean.audit(raw, AIR_QUALITY), "bucket", "rows"))
    assert counts == {"malformed": 1, "header": 1, "missing_timestamp": 2, "missing_parameter": 1,
                      "non_core": 1, "non_numeric": 1, "negative": 1, "bad_timestamp": 0, "kept": 3,
                      "unknown_city": 1}
    row = clean.reconcile(raw, AIR_QUALITY).first()
    assert (row.input_rows, row.dropped_rows, row.kept_rows, row.reconciles) == (11, 8, 3, True)
    assert clean.kept_readings(raw, AIR_QUALITY).count() == 3


def test_nan_and_infinity_are_gaps(spark):
    rows = [("s", float("nan")), ("s", float("inf")), ("s", -1.0), ("s", 0.0), ("s", None), ("s", 2.0)]
    raw = spark.createDataFrame(
        [(s, "n", "st", "ci", "CO", "mg/m³", dt.datetime(2024, 1, 1), v, "x") for s, v in rows],
        "station_id string, station_name string, state_name string, city_name string, "
        "parameter_name string, unit string, collected_at timestamp_ntz, value double, source string")
    kept = sorted(r.reading for r in clean.kept_readings(raw, AIR_QUALITY).collect())
    assert kept == [0.0, 2000.0]
    counts = dict(values(clean.audit(raw, AIR_QUALITY), "bucket", "rows"))
    assert (counts["kept"], counts["non_numeric"], counts["negative"]) == (2, 3, 1)


def test_duplicates_average_or_take_the_maximum(spark):
    df = readings(spark, [("s", "2024-01-01 00:00", "a", 10), ("s", "2024-01-01 00:00", "a", 20)])
    keys = ["station_id", "collected_at", "parameter_name"]
    assert clean.average_duplicates(df).first()["reading"] == 15.0
    assert reshape.pivot_mean(df, TWO).first()["a_ug_m3"] == 15.0
    assert reshape.pivot_max(df, TWO).first()["a_ug_m3"] == 20.0
    assert values(profile.grain_check(df, keys), "rows", "keys", "duplicates") == [(2, 1, 1)]


def test_fused_pivot_equals_two_steps(spark):
    rows = [("s", "2024-01-01 00:00", "a", v, city) for v, city in
            ((1, "C"), (2, "C"), (6, "D"), (9, "Unknown"))] + [("s", "2024-01-01 00:00", "b", 4)]
    df = readings(spark, rows)
    two_steps = reshape.pivot_mean(clean.average_duplicates(df), TWO).first()
    fused = reshape.merge_locations(reshape.located_hours(df, TWO), TWO).first()
    assert two_steps["a_ug_m3"] == pytest.approx(fused["a_ug_m3"]) == pytest.approx(5.5)
    assert fused["b_ug_m3"] == 4.0


def test_known_label_beats_unknown(spark):
    df = readings(spark, [("s", "2024-01-01 00:00", "a", 1, "Unknown"),
                          ("s", "2024-01-01 01:00", "a", 1, "Agra"),
                          ("t", "2024-01-01 00:00", "a", 1, "Unknown")])
    assert dict(values(clean.station_attributes(df), "station_id", "city_name")) == {
        "s": "Agra", "t": "Unknown"}


def test_correlation_of_gappy_and_constant_columns(spark):
    pairs = [(1.0, 2.0), (2.0, 4.0), (None, 9.0), (5.0, None), (3.0, 5.0)]
    df = spark.createDataFrame(pairs, "x double, y double")
    assert df.agg(pearson(F.col("x"), F.col("y")).alias("r")).first().r == pytest.approx(
        0.9819805060619659, abs=1e-12)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert flat.agg(pearson(F.col("x"), F.col("y")).alias("r")).first().r is None


def test_all_fifteen_pairs_and_metric_names_with_dots(spark):
    wide = spark.range(50).select(*[
        ((F.col("id") * (i + 3)) % (7 + i)).cast("double").alias(m.column)
        for i, m in enumerate(AIR_QUALITY)])
    pairs = correlate.correlation_pairs(wide, AIR_QUALITY)
    assert pairs.count() == 15 and "PM2.5-PM10" in [r.pair for r in pairs.collect()]
    expected = wide.toPandas().corr()
    for row in correlate.correlation_cells(wide, AIR_QUALITY, None).collect():
        names = {m.name: m.column for m in AIR_QUALITY}
        assert row.correlation == pytest.approx(
            expected.loc[names[row.row_metric], names[row.column_metric]], abs=1e-9)
    check = checks.matrix_checks(correlate.correlation_cells(wide, AIR_QUALITY)).first()
    assert (check.cells, check.symmetric, check.unit_diagonal, check.in_range) == (36, True, True, True)
    assert correlate.correlation_matrix(wide, AIR_QUALITY).columns == ["metric", *AIR_QUALITY.names]
    assert {r.pollutant for r in summaries.coverage(wide, AIR_QUALITY).collect()} == set(
        AIR_QUALITY.names)


def test_matrix_checks_reject_a_bad_matrix(spark):
    cells = spark.createDataFrame([("a", "a", 1.0), ("b", "b", 0.9), ("a", "b", 0.5), ("b", "a", 1.2)],
                                  "row_metric string, column_metric string, correlation double")
    row = checks.matrix_checks(cells).first()
    assert (row.symmetric, row.unit_diagonal, row.in_range) == (False, False, False)


def test_median_and_p99(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 4, 10)] + [("h", -5.0)], "g string, v double")
    out = {(r.g, r.probability): r.percentile
           for r in quantiles.percentiles(df, "v", [0.5, 0.99], ["g"]).collect()}
    assert out[("g", 0.5)] == 3.0 and out[("g", 0.99)] == pytest.approx(9.82)
    assert out[("h", 0.5)] == -5.0 == out[("h", 0.99)]


@pytest.mark.parametrize("bound", [None, 5])
def test_percentiles_equal_the_built_in(spark, bound):
    import random
    random.seed(7)
    rows = [(None if i % 11 == 0 else f"g{i % 4}",
             random.choice([0.0, 5.5, random.gauss(0, 3), random.expovariate(.01), None]))
            for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    mine = {(r.g, r.probability): r.percentile
            for r in quantiles.percentiles(df, "v", wanted, ["g"], bound).collect()}
    for row in df.groupBy("g").agg(F.percentile("v", wanted).alias("p")).collect():
        for p, expected in zip(wanted, row.p):
            assert mine[(row.g, p)] == pytest.approx(expected, abs=1e-9)


def test_percentiles_of_one_hot_value(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(
        F.col("id").cast("double")).alias("v"))
    mine = quantiles.percentiles(df, "v", [0.2, 0.5]).orderBy("probability").collect()
    truth = df.agg(F.percentile("v", [0.2, 0.5]).alias("p")).first().p
    assert [r.percentile for r in mine] == pytest.approx(truth)


def test_value_bucket_is_monotone(spark):
    points = sorted([-1e300, -5.0, -1e-300, 0.0, 5e-324, 1e-300, 1.0, 1.0000001, 1e300, -2.5, 3.7])
    df = spark.createDataFrame([(p,) for p in points], "v double").orderBy("v")
    buckets = [r.b for r in df.select(quantiles.value_bucket(F.col("v")).alias("b")).collect()]
    assert buckets == sorted(buckets)


def test_one_value_has_no_sample_variance(spark):
    wide = spark.createDataFrame([("s", 5.0, None)], "station_id string, a_ug_m3 double, b_ug_m3 double")
    rows = summaries.sample_statistics(wide, TWO).collect()
    assert len(rows) == 1
    assert (rows[0].pollutant, rows[0].n, rows[0].missing, rows[0].median, rows[0].variance) == (
        "a", 1, 0, 5.0, None)
    approx = summaries.sample_statistics(wide, TWO, exact=False).first()
    assert approx["median"] == 5.0
    long = readings(spark, [("s", "2024-01-01 00:00", "a", 5)])
    stats = {r.pollutant: r for r in summaries.population_statistics(long, TWO).collect()}
    assert stats["a"].variance == 0.0 and stats["b"].n == 0 and stats["b"].mean_value is None


def test_exceedance_counts_floor_and_ties(spark):
    rows = []
    for city in ("X", "Y"):
        rows += [(f"s{city}", f"2024-01-{d:02d} 01:00", "a", 20 if d <= 2 else 1, city)
                 for d in range(1, 5)]
    rows += [("sZ", "2024-01-01 01:00", "a", 99, "Z"), ("sX", "2024-01-01 02:00", "a", 20, "X"),
             ("sX", "2024-01-01 03:00", "b", 50, "X"), ("sX", "2024-01-01 09:00", "b", 1, "X")]
    wide = reshape.merge_locations(reshape.located_hours(readings(spark, rows), TWO), TWO)
    counts = exceed.city_counts(wide, TWO)
    cities = {(r.city_name, r.pollutant): r for r in
              exceed.city_exceedance(counts, 2).collect()}
    assert set(cities) == {("X", "a"), ("Y", "a"), ("X", "b")}
    assert (cities["X", "a"].n, cities["X", "a"].over, cities["X", "a"].pct) == (4, 2, 50.0)
    assert cities["X", "a"]["mean"] == pytest.approx((20 + 20 + 1 + 1) / 4)
    assert (cities["X", "b"].n, cities["X", "b"].pct) == (2, 50.0)
    net = {r.pollutant: r for r in exceed.network_exceedance(counts, TWO, 2).collect()}
    assert (net["a"].observations, net["a"].exceedances) == (9, 5)
    assert (net["a"].worst_city, net["a"].worst_city_pct_above) == ("X", 50.0)
    assert net["a"].cities_with_mean_above == 3 and net["a"].observation_unit == "station-days"
    assert net["b"].observation_unit == "8-hour blocks"
    table = exceed.exceedance_by_city(exceed.city_exceedance(counts, 2), TWO)
    worst = exceed.worst_cities(table, TWO, 1).first()
    assert (worst.city_name, worst.worst_pct, worst["b_n"]) == ("X", 50.0, 2)
    offenders = dict(values(exceed.with_main_offender(table, TWO), "city_name", "main_offender"))
    assert offenders == {"X": "a", "Y": "a"}
    best = exceed.exceedance_highlights(exceed.city_exceedance(counts, 2), 2).orderBy("rank").collect()
    assert [(r["rank"], r.city_name, r.pollutant, r.exceeding_pairs) for r in best] == [
        (1, "X", "a", 3), (2, "X", "b", 3)]
    assert exceed.window_means(wide, TWO, min_hours=2).count() == 1


def test_windows_of_one_hour_and_metrics_without_readings(spark):
    hourly = MetricSpec((Metric("a", "a", 10, "1-hour", 5, "24-hour", 99),
                         Metric("quiet", "quiet", 10, "24-hour", 5, "24-hour", 99)))
    rows = [("s", f"2024-01-01 {h:02d}:00", "a", 20 if h == 3 else 1, "X") for h in range(8)]
    hours = reshape.merge_locations(reshape.located_hours(readings(spark, rows), hourly), hourly)
    net = {r.pollutant: r for r in exceed.network_exceedance(
        exceed.city_counts(hours, hourly), hourly, 1).collect()}
    assert (net["a"].observations, net["a"].exceedances, net["a"].observation_unit) == (8, 1, "1-hour blocks")
    assert (net["quiet"].observations, net["quiet"].exceedances, net["quiet"].pct_above,
            net["quiet"].worst_city) == (0, 0, None, None)
    with pytest.raises(ValueError):
        Metric("a", "a", 10, "weekly", 5, "24-hour", 99)


def test_hours_floor_leaves_city_means_alone(spark):
    rows = [("s", "2024-01-01 01:00", "a", 90, "X"), ("s", "2024-01-02 01:00", "a", 1, "X"),
            ("s", "2024-01-02 02:00", "a", 1, "X")]
    hours = reshape.merge_locations(reshape.located_hours(readings(spark, rows), TWO), TWO)
    counts = exceed.city_counts(hours, TWO, min_hours=2)
    row = counts.first()
    assert (row.n, row.over, row.total, row.hours) == (1, 0, 92.0, 3)


def test_audit_and_cleaning_keep_the_same_rows(spark):
    typed = spark.createDataFrame(
        [(" PM2.5 ", 5.0), ("PM2.5", -1.0), ("x", 5.0), ("PM2.5", float("nan")), (None, 5.0)],
        "parameter_name string, value double").selectExpr(
            "1 AS station_id", "'S' AS state_name", "'C' AS city_name", "parameter_name", "'ug' AS unit",
            "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS collected_at", "value", "'src' AS source")
    text = spark.createDataFrame(
        [(" PM2.5 ", "10", "bad"), ("PM2.5", "30", "worse"), ("PM2.5", "50", "2024-01-01 01:00:00"), ("PM2.5", "7", " ")],
        "parameter_name string, value string, collected_at string").selectExpr(
            "'1' AS station_id", "'S' AS state_name", "'C' AS city_name", "parameter_name", "'ug' AS unit",
            "collected_at", "value", "'src' AS source")
    for raw in (typed, text):
        buckets = {r.bucket: r["rows"] for r in clean.audit(raw, AIR_QUALITY).collect()}
        assert buckets["kept"] == clean.kept_readings(raw, AIR_QUALITY).count() == 1
        assert clean.reconcile(raw, AIR_QUALITY).first().reconciles
    assert buckets["bad_timestamp"] == 2 and buckets["missing_timestamp"] == 1


def test_main_offender_skips_missing_metrics(spark):
    frame = spark.createDataFrame([("c", None, 10.0, 10.0)],
                                  "city string, a_pct double, b_pct double, c_pct double")
    spec = MetricSpec((*TWO.metrics, Metric("c", "c", 1, DAILY, 1, DAILY, 1)))
    assert exceed.with_main_offender(frame, spec).first().main_offender == "b"


def test_peak_ties_take_the_earlier_hour(spark):
    df = spark.createDataFrame([(3, 5.0), (7, 5.0), (9, 1.0), (4, 1.0)], "hour int, a_avg double")
    row = summaries.peak_and_trough(df, TWO.only("a")).first()
    assert (row.peak_hour, row.trough_hour) == (3, 4)


def test_funnel_and_extremes(spark):
    wide = spark.createDataFrame(
        [("s1", 1.0, 1.0), ("s1", 2.0, None), ("s2", 9.0, None), ("s2", 9.0, None), ("s3", 5.0, 5.0),
         ("s4", None, 5.0)], "station_id string, a_ug_m3 double, b_ug_m3 double"
    ).withColumns({"state_name": F.lit("S"), "city_name": F.lit("C")})
    funnel = dict(values(summaries.feature_funnel(wide, TWO, 2), "metric", "value"))
    assert funnel == {"stations with the primary metric": 3, "stations with enough hours": 2,
                      "stations with all metrics": 2, "stations in feature table": 1}
    assert [r.station_id for r in summaries.station_features(wide, TWO, 2).collect()] == ["s1"]
    assert summaries.station_features(wide, TWO, 2, require_all=False).count() == 2


def test_histogram_closes_its_last_bin(spark):
    df = readings(spark, [("s", f"2024-01-01 {h:02d}:00", "a", h) for h in range(24)])
    bins = report.density_histogram(df, TWO, bins=4, quantile=1.0).orderBy("bin").collect()
    assert [b.n for b in bins] == [6, 6, 6, 6]
    assert sum(b.density for b in bins) * (23 / 4) == pytest.approx(1.0)
    flat = readings(spark, [("s", "2024-01-01 00:00", "a", 5), ("s", "2024-01-01 01:00", "a", 5)])
    assert sum(b.n for b in report.density_histogram(flat, TWO, bins=4).collect()) == 2


def test_reconciliation_detects_a_missing_row(spark):
    a = spark.createDataFrame([("k", 2), ("m", 1)], "k string, n long")
    b = spark.createDataFrame([("k", 2), ("x", 1)], "k string, n long")
    assert checks.counts_agree(a, a, ["k"], "n").count() == 0
    assert checks.counts_agree(a, b, ["k"], "n").count() == 2
    assert checks.totals_agree(a, a, "n").first().agree


def test_plausibility_and_conversion(spark):
    df = readings(spark, [("s", "2024-01-01 00:00", "a", 150), ("s", "2024-01-01 00:00", "b", 60)])
    rows = {r.pollutant: r for r in checks.plausibility(df, TWO).collect()}
    assert (rows["a"].above_ceiling, rows["a"].plausible, rows["b"].plausible) == (1, False, True)
    assert checks.conversion_check(df, "b", 50).first().converted_rows == 1


def test_bars_and_relative_change(spark):
    series = spark.createDataFrame([(1, 50.0), (2, 100.0), (3, 0.5)], "k int, v double")
    assert [r.height for r in report.bar_heights(series, "v").orderBy("k").collect()] == [50, 100, 2]
    change = [r.relative_change for r in report.relative_change(series, "k", "v").orderBy("k").collect()]
    assert change[0] is None and change[1] == 0.5 and math.isclose(change[2], 199.0)


def test_all_units_are_named(spark):
    rows = spark.range(150).selectExpr("'m' AS parameter_name", "lpad(id, 3, '0') AS unit")
    one = profile.unit_report(rows.union(rows)).collect()
    assert [(r["distinct_units"], r["units"].split(", ")) for r in one] == [(150, [f"{i:03d}" for i in range(150)])]
    few = profile.unit_report(rows, listed=2).first()
    assert (few["units"], few["distinct_units"], few["mixed"]) == ("000, 001", 150, True)
