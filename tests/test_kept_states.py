"""What is kept between loads: streamed windows, states, co-moments, sketches, layouts, reconciliation."""
from __future__ import annotations

import itertools
import math
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.model import AIR_QUALITY, RAW_SCHEMA, MetricSpec
from gaugeworks.operators import clean, comoments, reconcile, sketches, states, summaries
from gaugeworks.plans.catalog import QUERIES
from gaugeworks.plans.tables import LINES, Tables
from gaugeworks.sources import bucketed, incremental, readers, writers
from gaugeworks.streaming import windows
from tests.conftest import SF_DIR

START = datetime(2024, 3, 1)


def raw_frame(spark, rows):
    """Rows of (station, metric, hours after the start, value[, unit])."""
    return spark.createDataFrame(
        [(s, "name", "State", "City", m, (u or ["µg/m³"])[0], START + timedelta(hours=h), float(v), "src")
         for s, m, h, v, *u in rows], RAW_SCHEMA)


# ---- streamed windows

class Folders:
    def __init__(self, root):
        self.source, self.target, self.log = (str(root / n) for n in ("in", "out", "log"))

    def load(self, spark, rows):
        raw_frame(spark, rows).coalesce(1).write.mode("append").parquet(self.source)

    def drain(self, spark, **options):
        query = windows.publish_windows(spark, self.source, self.target, self.log, AIR_QUALITY, delay="6 hours", **options)
        query.awaitTermination()
        return query

    def rows(self, spark):
        return {(r.station_id, r.parameter_name, r.date.day, r.block): (round(r.mean, 6), r.hours, r.rows)
                for r in windows.published(spark, self.target).collect()}


def test_state_has_a_few_parts_per_core(spark, tmp_path):
    f, before = Folders(tmp_path), spark.conf.get("spark.sql.shuffle.partitions")
    f.load(spark, [("a", "PM2.5", h, h) for h in range(48)])
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        f.drain(spark)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    parts = [p for p in (tmp_path / "log" / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(parts) == windows.STATES_PER_CORE * spark.sparkContext.defaultParallelism
    assert f.rows(spark) == {("a", "PM2.5", 1, None): (11.5, 24, 24)}


def test_windows_are_published_once_over_restarts(spark, tmp_path):
    f = Folders(tmp_path)
    first = [("a", "PM2.5", h, h) for h in range(24)] + [("a", "CO", h, 1, "mg/m³") for h in range(16)]
    f.load(spark, first)
    f.drain(spark)
    # The watermark is at 23:00 - 6 h = 17:00, so two blocks of CO are over and the day is not.
    assert f.rows(spark) == {("a", "CO", 1, 0): (1000.0, 8, 8), ("a", "CO", 1, 1): (1000.0, 8, 8)}
    # Repeated readings are averaged first; a reading that comes late but before the watermark counts.
    f.load(spark, [("a", "PM2.5", 20, 60), ("b", "PM2.5", 19, 5), ("a", "PM2.5", 60, 7)])
    f.drain(spark)
    hours = [*range(20), (20 + 60) / 2, 21, 22, 23]
    day = ("a", "PM2.5", 1, None)
    assert f.rows(spark)[day] == (round(sum(hours) / 24, 6), 24, 25)
    assert f.rows(spark)["b", "PM2.5", 1, None] == (5.0, 1, 1)
    # Behind the watermark: dropped, and what was published stays as it is.
    before = f.rows(spark)
    f.load(spark, [("a", "PM2.5", 5, 999), ("c", "CO", 2, 999)])
    f.drain(spark)
    assert f.rows(spark) == before
    windows.close_stream(spark, f.source, AIR_QUALITY, START + timedelta(days=20))
    f.drain(spark)
    done = f.rows(spark)
    assert done["a", "PM2.5", 3, None] == (7.0, 1, 1)
    assert set(done) - set(before) == {("a", "PM2.5", 3, None)}
    kept = clean.kept_readings(spark.read.schema(RAW_SCHEMA).parquet(f.source), AIR_QUALITY).where("station_id IS NOT NULL")
    late = {r.pollutant: (r.kept, r.published, r.late) for r in windows.late_readings(kept, windows.published(spark, f.target)).collect()}
    assert late == {"PM2.5": (28, 27, 1), "CO": (17, 16, 1)}
    # Nothing new: nothing happens.
    f.drain(spark)
    assert f.rows(spark) == done


def test_a_load_that_breaks_off_is_repeated_whole(spark, tmp_path):
    f = Folders(tmp_path)
    for day in range(4):
        f.load(spark, [("a", "PM2.5", 24 * day + h, day) for h in range(24)])
    f.drain(spark, max_files=1)
    days = f.rows(spark)
    assert sorted(k[2] for k in days) == [1, 2, 3]
    # The log says the last batch was planned; without its commit a restart runs it again.
    commits = sorted((int(p.name), p) for p in (tmp_path / "log" / "commits").iterdir() if p.name.isdigit())
    last = commits[-1][1]
    last.rename(tmp_path / "commit-lost")
    crc = last.with_name(f".{last.name}.crc")
    if crc.exists():
        crc.rename(tmp_path / "crc-lost")
    f.drain(spark, max_files=1)
    assert f.rows(spark) == days
    assert windows.published(spark, f.target).count() == len(days)


def test_windows_do_not_depend_on_the_session_zone(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        f = Folders(tmp_path)
        # The night of 10 March has no 02:00 there.
        f.load(spark, [("a", "PM2.5", 24 * 9 + h, h) for h in range(24)] + [("a", "PM2.5", 24 * 15, 1)])
        f.drain(spark)
        assert f.rows(spark) == {("a", "PM2.5", 10, None): (11.5, 24, 24)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# ---- states per month

def tree_of(spark, path, rows, mode="append"):
    frame = spark.createDataFrame([("s", "n", "S", c, m, "u", datetime(2024, month, 2), v, "x", 2024, month)
                                   for month, c, m, v in rows],
                                  "station_id string, station_name string, state_name string, city_name string, parameter_name "
                                  "string, unit string, collected_at timestamp_ntz, value double, source string, year int, month int")
    frame.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)


def keep(raw):
    return clean.kept_readings(raw, AIR_QUALITY, carry=incremental.PARTITIONS)


def summary(spark, kept):
    return {(r.city, r.pollutant): (r.reading_count, round(r.mean, 9), r.min, r.max)
            for r in states.finished(states.merge_states(states.read_states(spark, kept))).collect()}


def test_only_changed_partitions_are_read(spark, tmp_path):
    tree, kept = str(tmp_path / "tree"), str(tmp_path / "states")
    tree_of(spark, tree, [(1, "C", "PM2.5", 1.0), (1, "C", "PM2.5", 3.0), (1, None, "CO", 5.0), (2, "C", "PM2.5", 8.0),
                          (3, "C", "nothing", 8.0)])
    assert states.refresh_states(spark, tree, kept, keep) == [(2024, 1), (2024, 2), (2024, 3)]
    want = {("C", "PM2.5"): (3, 4.0, 1.0, 8.0), ("Unknown", "CO"): (1, 5.0, 5.0, 5.0)}
    assert summary(spark, kept) == want
    assert states.refresh_states(spark, tree, kept, keep) == []
    # A new month, and a month that grew.
    tree_of(spark, tree, [(4, "D", "CO", 2.0), (2, "C", "PM2.5", 0.5)])
    assert states.stale_partitions(spark, tree, kept) == [(2024, 2), (2024, 4)]
    read = []
    assert states.refresh_states(spark, tree, kept, lambda raw: (read.append(raw), keep(raw))[1]) == [(2024, 2), (2024, 4)]
    assert {f.split("month=")[1].split("/")[0] for r in read for f in r.inputFiles()} >= {"2", "4"}
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    want |= {("C", "PM2.5"): (4, 3.125, 0.5, 8.0), ("D", "CO"): (1, 2.0, 2.0, 2.0)}
    assert summary(spark, kept) == want
    # A month delivered anew replaces its state.
    tree_of(spark, tree, [(1, "C", "PM2.5", 100.0)], mode="overwrite")
    assert states.refresh_states(spark, tree, kept, keep) == [(2024, 1)]
    assert summary(spark, kept) == {("C", "PM2.5"): (3, 36.166666667, 0.5, 100.0), ("D", "CO"): (1, 2.0, 2.0, 2.0)}


def test_files_that_arrive_during_a_refresh_are_read_by_the_next(spark, tmp_path):
    tree, kept = str(tmp_path / "tree"), str(tmp_path / "states")
    tree_of(spark, tree, [(1, "C", "CO", 1.0)])

    def keep_while_more_arrives(raw):
        tree_of(spark, tree, [(1, "C", "CO", 3.0), (2, "C", "CO", 5.0)])
        return keep(raw)

    assert states.refresh_states(spark, tree, kept, keep_while_more_arrives) == [(2024, 1)]
    assert states.refresh_states(spark, tree, kept, keep) == [(2024, 1), (2024, 2)]
    assert summary(spark, kept) == {("C", "CO"): (3, 3.0, 1.0, 5.0)}
    assert states.refresh_states(spark, tree, kept, keep) == []


def test_a_partition_that_is_gone_leaves_the_summary(spark, tmp_path):
    tree, kept = tmp_path / "tree", str(tmp_path / "states")
    tree_of(spark, str(tree), [(1, "C", "PM2.5", 1.0), (2, "C", "PM2.5", 3.0)])
    states.refresh_states(spark, str(tree), kept, keep)
    (tree / "year=2024" / "month=1").rename(tmp_path / "gone")
    assert states.refresh_states(spark, str(tree), kept, keep) == [(2024, 1)]
    assert summary(spark, kept) == {("C", "PM2.5"): (1, 3.0, 3.0, 3.0)}
    assert states.refresh_states(spark, str(tree), kept, keep) == []


def test_states_merge_in_any_order_and_empty_ones_count_zero(spark):
    rows = [("C", "PM2.5", float(v)) for v in range(10)]
    frame = spark.createDataFrame(rows, "city_name string, parameter_name string, reading double")
    parts = [states.partial_states(frame.where(c), states.GROUP) for c in ("reading < 3", "reading >= 3", "reading > 99")]
    for order in itertools.permutations(parts):
        merged = states.merge_states(order[0].unionByName(order[1]).unionByName(order[2])).first()
        assert tuple(merged) == ("C", "PM2.5", 10, 45.0, 0.0, 9.0)
    empty = spark.createDataFrame([("C", "CO", 0, None, None, None)],
                                  "city_name string, parameter_name string, n long, total double, low double, high double")
    assert states.finished(empty).first()["mean"] == 0.0
    assert states.merge_states(empty).count() == 0


# ---- co-moments

def wide_rows(seed, n):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        values = [float(x) if rng.random() > 0.2 else None for x in 1e6 + rng.normal(size=4)]
        rows.append((f"s{i % 7}", f"S{i % 2}", f"C{i % 7 % 3}", i % 4, *values[:3], 5.25))
    return rows


WIDE = "station_id string, state_name string, city_name string, load int, " + ", ".join(f"{c} double" for c in LINES.columns)
KEYS = ["station_id", "state_name", "city_name"]


def brute_levels(rows):
    out = {}
    for level, size in (("network", 0), ("state", 1), ("city", 2)):
        groups = defaultdict(list)
        for r in rows:
            groups[(r[1], r[2])[:size]].append(r[4:])
        for place, values in groups.items():
            for (i, a), (j, b) in itertools.combinations(enumerate(LINES), 2):
                both = np.array([(v[i], v[j]) for v in values if v[i] is not None and v[j] is not None])
                if len(both):
                    x, y = (both - both.mean(0)).T
                    r = None if x.std() == 0 or y.std() == 0 else (x * y).sum() / math.sqrt((x * x).sum() * (y * y).sum())
                    out[level, *place, f"{a.name}-{b.name}"] = (len(both), r)
    return out


def levels_of(stations):
    return {(r.level, *[p for p in (r.state_name, r.city_name) if p is not None], r.pair): (r.n, r.correlation)
            for r in comoments.correlation_levels(stations, digits=None).collect()}


def same_levels(got, want):
    assert set(got) == set(want)
    for key, (n, r) in want.items():
        assert got[key][0] == n
        assert (got[key][1] is None) == (r is None), key
        assert r is None or got[key][1] == pytest.approx(r, abs=1e-6), key


def test_levels_from_station_states_equal_brute_force(spark):
    rows = wide_rows(1, 400)
    wide = spark.createDataFrame(rows, WIDE).repartition(4)
    same_levels(levels_of(comoments.pair_states(wide, LINES, KEYS)), brute_levels(rows))


def test_loads_merge_pairwise(spark):
    rows = wide_rows(2, 300)
    # A station that only one load has, and a single row on one side.
    rows += [("only", "S9", "C9", 3, 1.0, 2.0, 3.0, 4.0), ("only", "S9", "C9", 3, 2.0, 2.5, None, 4.0), ("one", "S9", "C9", 0, 1.0, 1.0, 1.0, 1.0)]
    wide = spark.createDataFrame(rows, WIDE)
    loads = [comoments.pair_states(wide.where(F.col("load") == n), LINES, KEYS) for n in range(4)]
    merged = comoments.merge_pairwise(comoments.merge_pairwise(loads[0], loads[1], KEYS),
                                      comoments.merge_pairwise(loads[2], loads[3], KEYS), KEYS)
    same_levels(levels_of(merged), brute_levels(rows))
    monthly = comoments.pair_states(wide, LINES, [*KEYS, "load"])
    same_levels(levels_of(comoments.roll_up(monthly, KEYS)), brute_levels(rows))


def test_no_level_reads_the_wide_table_again(spark, tmp_path):
    stations = comoments.pair_states(spark.createDataFrame(wide_rows(3, 50), WIDE), LINES, KEYS)
    stations.write.parquet(str(tmp_path / "stations"))
    levels = comoments.correlation_levels(spark.read.parquet(str(tmp_path / "stations")))
    assert {f.split("/")[-2] for f in levels.inputFiles()} == {"stations"}


# ---- sketches

def test_quantiles_stay_within_the_stated_rank_error(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.lognormal(size=60_000), np.full(6_000, 1.0)]).round(3)
    frame = spark.createDataFrame([(f"C{i % 2}", "m", 2020 + i % 3, 1 + i % 12, float(v)) for i, v in enumerate(values)],
                                  "city_name string, parameter_name string, year int, month int, reading double").repartition(6)
    shares = {"low": 0.0, "q10": 0.1, "median": 0.5, "p99": 0.99, "high": 1.0}
    merged = sketches.merge_quantiles(sketches.quantile_states(frame))
    found = sketches.quantiles_of(merged, shares).persist()
    errors = sketches.rank_errors(frame, found, shares).collect()
    assert len(errors) == 2
    for r in errors:
        assert all(r[f"{q}_rank_error"] <= sketches.rank_bound() for q in shares)
    for r in found.collect():
        own = values[np.arange(len(values)) % 2 == int(r.city_name[1])]
        assert (r.n, r.low, r.high) == (len(own), own.min(), own.max())
        exact = np.sort(own)
        for q in ("q10", "median", "p99"):
            span = [np.searchsorted(exact, r[q], side) / len(own) for side in ("left", "right")]
            assert span[0] - shares[q] <= sketches.rank_bound() and shares[q] - span[1] <= sketches.rank_bound()


def test_rank_errors_tell_a_wrong_estimate(spark):
    frame = spark.createDataFrame([("C", "m", float(v)) for v in range(100)], "city_name string, parameter_name string, reading double")
    wrong = spark.createDataFrame([("C", "m", 80.0)], "city_name string, parameter_name string, median double")
    assert sketches.rank_errors(frame, wrong, {"median": 0.5}).first()["median_rank_error"] == pytest.approx(0.3)


def test_stations_of_a_year_from_twelve_months(spark):
    rows = spark.range(60_000).select(F.concat(F.lit("s"), F.col("id") % 25_000).alias("station_id"),
                                      (2020 + F.col("id") % 2).cast("int").alias("year"), (1 + F.col("id") % 12).cast("int").alias("month"))
    months = sketches.station_states(rows)
    assert months.count() == 12
    got = {r.year: r for r in sketches.stations_and_stayers(sketches.merge_stations(months)).collect()}
    exact = {r.year: r.n for r in rows.groupBy("year").agg(F.count_distinct("station_id").alias("n")).collect()}
    for year, n in exact.items():
        # Nominal size 4,096: relative standard error 1 / sqrt(4,096), here three of them.
        assert abs(got[year].stations - n) <= 3 * n / 64
    assert got[2020].stayed == 0
    few = rows.where("id < 3000")
    small = {r.year: r.stations for r in sketches.stations_and_stayers(sketches.merge_stations(sketches.station_states(few))).collect()}
    assert small == {2020: 1500, 2021: 1500}


# ---- all places in one pass

def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_places_come_from_one_scan(spark, tmp_path):
    t = Tables(spark, SF_DIR)
    t.bulk_table.write.parquet(str(tmp_path / "clean"))
    assert scans(summaries.place_levels(spark.read.parquet(str(tmp_path / "clean")), LINES)) == 1


def test_a_nameless_place_is_no_total(spark):
    rows = [("a", None, "S", "quantity", 1.0), ("b", "C", "S", "quantity", 3.0), ("b", "C", None, "price", 5.0)]
    frame = spark.createDataFrame(rows, "station_id string, city_name string, state_name string, parameter_name string, reading double")
    got = {(r.level, r.state_name, r.city_name): (r.stations, r.readings, r.quantity_avg)
           for r in summaries.place_levels(frame, LINES).collect()}
    assert got == {("city", "S", None): (1, 1, 1.0), ("city", "S", "C"): (1, 1, 3.0), ("city", None, "C"): (1, 1, None),
                   ("state", "S", None): (2, 2, 2.0), ("state", None, None): (1, 1, None), ("network", None, None): (2, 3, 2.0)}


# ---- layouts

def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_joins_exchange_nothing(spark):
    for name in ("j1_bucketed_attributes", "j3_bucketed_complete_cases"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert "SortMergeJoin" in plan and "Exchange" not in plan, name


def test_bucketed_tables_are_replaced(spark, tmp_path):
    a = spark.createDataFrame([(i, i) for i in range(100)], "k int, v int")
    for rows in (a, a.where("k < 10")):
        table = bucketed.write_bucketed(rows, "gaugeworks_replaced", str(tmp_path / "t"), ["k"], buckets=4)
    assert table.count() == 10


def test_calendar_prunes_directories(spark, tmp_path):
    tree = str(tmp_path / "tree")
    tree_of(spark, tree, [(m, "C", "PM2.5", float(m)) for m in range(1, 13)])
    spark.createDataFrame([(2024, 3, "spring"), (2024, 4, "spring"), (2024, 4, "spring"), (2024, 12, "winter"), (2025, 3, "spring")],
                          "year int, month int, season string").write.parquet(str(tmp_path / "calendar"))
    spring = spark.read.parquet(str(tmp_path / "calendar")).where("season = 'spring'")
    found = readers.read_tree_when(spark, tree, spring, columns=["value", "month"])
    assert sorted(r.value for r in found.collect()) == [3.0, 4.0] and found.columns == ["value", "month"]
    plan = found._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    leaves = plan.executedPlan().collectLeaves() if hasattr(plan, "executedPlan") else plan.collectLeaves()
    read = []
    stack = [leaves.apply(i) for i in range(leaves.size())]
    while stack:
        node = stack.pop()
        if "QueryStage" in node.getClass().getSimpleName():
            more = node.plan().collectLeaves()
            stack += [more.apply(i) for i in range(more.size())]
        elif "FileSourceScan" in node.getClass().getSimpleName() and "tree" in node.toString():
            read.append(node.metrics().apply("numFiles").value())
    assert read and max(read) == 2


# ---- reconciliation

def test_a_changed_row_is_found_and_others_do_not_meet(spark, tmp_path):
    columns = ["k", "m", "v"]
    rows = [(f"s{i % 20}", i % 5, float(i)) for i in range(400)] + [("s1", 1, None), ("s2", 2, 7.0), ("s2", 2, 7.0)]
    left = spark.createDataFrame(rows, "k string, m int, v double").repartition(3)
    changed = [r if r != ("s3", 3, 3.0) else ("s3", 3, 3.5) for r in rows]
    changed.remove(("s2", 2, 7.0))
    right = spark.createDataFrame(changed + [("new", 9, 1.0)], "k string, m int, v double").repartition(5)
    keys = {"k": F.col("k"), "m": F.col("m")}
    groups = reconcile.differing_groups(left, right, keys, columns)
    assert {(r.k, r.m): (r.left_rows, r.right_rows) for r in groups.collect()} == {
        ("s3", 3): (20, 20), ("s2", 2): (22, 21), ("new", 9): (None, 1)}
    groups.write.parquet(str(tmp_path / "groups"))
    found = reconcile.differing_rows(left, right, spark.read.parquet(str(tmp_path / "groups")), keys, columns)
    assert sorted((r.k, r.v, r.side, r.surplus) for r in found.collect()) == [
        ("new", 1.0, "right", 1), ("s2", 7.0, "left", 1), ("s3", 3.0, "left", 1), ("s3", 3.5, "right", 1)]
    assert reconcile.differing_groups(left, left.repartition(7), keys, columns).count() == 0
