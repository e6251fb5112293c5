"""Round trips, incremental loads, streaming load, and the whole workflow."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeworks.model import AIR_QUALITY, CSV_COLUMNS, RAW_SCHEMA
from gaugeworks.operators import clean
from gaugeworks.plans import workflow
from gaugeworks.plans.tables import LINES, Tables
from gaugeworks.session import fresh_path, shared_folder
from gaugeworks.sources import incremental, readers, writers
from gaugeworks.streaming.ingest import load_new_files
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def raw(spark):
    """A hundred days of hourly readings at twelve stations, every metric, planted faults."""
    hours = spark.range(12 * 24 * 100).select(
        (F.col("id") % 12).alias("n"), (F.col("id") / 12).cast("int").alias("h"))
    values = hours.select("*", F.inline(F.array(*[F.struct(
        F.lit(m.name).alias("parameter_name"), F.lit(10.0 * (i + 1)).alias("base"))
        for i, m in enumerate(AIR_QUALITY)])))
    at = F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(hours=F.col("h"))
    noise = (F.xxhash64("n", "h", "parameter_name") % 1000) / 100.0
    return values.select(
        F.concat(F.lit("site_"), F.col("n")).alias("station_id"), F.lit("Hall, East").alias("station_name"),
        F.lit("State").alias("state_name"),
        F.when(F.col("n") != 11, F.concat(F.lit("City"), F.col("n") % 3)).alias("city_name"),
        "parameter_name", F.when(F.col("parameter_name") == "CO", "mg/m³").otherwise("µg/m³").alias("unit"),
        at.alias("collected_at"),
        F.when((F.col("h") % 97 == 0) & (F.col("n") == 3), -1.0)
         .otherwise(F.col("base") + F.abs(noise) + F.when(F.col("n") > 5, 50).otherwise(0)).alias("value"),
        F.lit("net").alias("source"))


def test_quoted_commas_and_wrong_field_counts(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    header = ",".join(CSV_COLUMNS)
    (path / "a.csv").write_text(header + '\ns1,S,"New, Delhi",CO,u,t,1,x\ns2,S\n')
    (path / "b.csv").write_text(header + "\ns3,S,C,CO,u,t,1,x,extra\n")
    rows = {r.station_id: r.city_name for r in readers.read_csv_parts(spark, str(path)).collect()}
    assert rows == {"s1": "New, Delhi", "s2": None, "s3": "C"}
    bad = readers.read_csv_flagging(spark, str(path)).where("_bad_row is not null").collect()
    assert {r._bad_row.split(",")[0] for r in bad} == {"s2", "s3"}
    marked = readers.split_lines(readers.read_lines(spark, str(path)))
    assert marked.where("malformed").count() == 1
    report = readers.header_report(spark, str(path)).collect()
    assert all(r.conforms for r in report) and len(report) == 2
    (path / "c.csv").write_text("s4,S,C,CO,u,t,1,x\n" + header + "\n")
    late = {r.file_path.rsplit("/", 1)[-1]: r for r in readers.header_report(spark, str(path)).collect()}
    assert not late["c.csv"].conforms and late["c.csv"].header_lines == 1 and late["a.csv"].conforms


def test_month_filter_prunes_directories_and_columns(spark, raw):
    tree = fresh_path(spark, "tree")
    writers.write_tree(raw.select("*", F.year("collected_at").alias("year"),
                                  F.month("collected_at").alias("month")), tree)
    df = readers.read_tree(spark, tree, "2,3", ["parameter_name", "value"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month" in plan and "ReadSchema: struct<parameter_name:string,value:double>" in plan
    expected = raw.where(F.month("collected_at").isin(2, 3)).count()
    assert df.count() == expected


def test_incremental_load_keeps_what_is_there(spark, raw):
    target = fresh_path(spark, "target")
    rows = raw.select("*", F.year("collected_at").alias("year"), F.month("collected_at").alias("month"))
    incremental.publish_missing(rows.where("month = 1").withColumn("source", F.lit("first")), target)
    incremental.publish_missing(rows, target)
    incremental.publish_missing(rows, target)
    loaded = spark.read.parquet(target)
    assert loaded.count() == rows.count()
    assert [r.source for r in loaded.where("month = 1").select("source").distinct().collect()] == ["first"]


def test_incremental_load_opens_missing_partitions_only(spark, raw):
    source, target = fresh_path(spark, "source"), fresh_path(spark, "published")
    rows = raw.select("*", F.year("collected_at").alias("year"), F.month("collected_at").alias("month"))
    rows.write.partitionBy("year", "month").parquet(source)
    tree = spark.read.parquet(source)
    incremental.publish_missing(tree.where("month = 1"), target)
    missing = incremental.missing_rows(tree, target)
    assert {r.month for r in missing.select("month").distinct().collect()} == {2, 3, 4}
    plan = missing._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: ["):].split("]")[0]
    assert "month" in filters and "Join" not in plan
    missing.write.format("noop").mode("overwrite").save()
    assert incremental.present_partitions(spark, fresh_path(spark, "nothing")) == []


def test_stream_reads_each_file_once(spark, raw):
    source, target, mark = (fresh_path(spark, x) for x in ("in", "out", "mark"))
    columns = RAW_SCHEMA.fieldNames()
    raw.where(F.month("collected_at") == 1).select(*columns).write.parquet(source)
    load_new_files(spark, source, target, mark, AIR_QUALITY, max_files=1).awaitTermination(120)
    first = spark.read.parquet(target).count()
    raw.where(F.month("collected_at") == 2).select(*columns).write.mode("append").parquet(source)
    for _ in range(2):
        load_new_files(spark, source, target, mark, AIR_QUALITY).awaitTermination(120)
    kept = clean.kept_readings(raw.where(F.month("collected_at") <= 2), AIR_QUALITY)
    assert spark.read.parquet(target).count() == kept.count() > first > 0


def test_shared_folder_is_the_clusters(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_workflow_end_to_end(spark, raw):
    paths = workflow.run(spark, raw, fresh_path(spark, "run"), ks=range(2, 4), restarts=2)
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    audit = {r.bucket: r["rows"] for r in read["audit"].collect()}
    assert audit["kept"] + audit["negative"] == raw.count() and audit["negative"] == 25 * 6
    features = read["station_features"].collect()
    assert len(features) == 12 and min(f.co_avg for f in features) > 1000
    assert read["cluster_assignments"].count() == 12
    assert read["cluster_status"].first().status == "clustered"
    assert read["reconciliation"].first().reconciles
    assert {r.measure for r in read["cluster_k_table"].collect()} == {"squaredEuclidean"}
    assert read["cluster_choice"].first()["chosen_k"] == 2
    assert read["correlation_pairs"].count() == 15
    network = {r.pollutant: r for r in read["exceedance_network"].collect()}
    assert network["CO"].exceedances == network["CO"].observations
    assert read["histogram"].count() == 6 * 60
    assert read["coverage"].where("pollutant = 'CO'").first()["missing"] == 0


def test_skewed_station_is_split(spark, tmp_path):
    """One station holds most rows: the join that locates it must be split, with equal results."""
    tables = Tables(spark, SF_DIR)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    events = tables.table("events")
    copies = F.explode(F.array_repeat(F.lit(3).cast("bigint"), 60)).alias("user_id")
    hot = events.unionByName(events.drop("user_id").select("*", copies))
    folder = str(tmp_path)
    hot.repartition(8).write.parquet(f"{folder}/events.parquet")
    for name in ("customer", "nation", "region"):
        tables.table(name).write.parquet(f"{folder}/{name}.parquet")
    plain = Tables(spark, folder).kept.groupBy("city_name").agg(F.count("*").alias("n"))
    expected = sorted(map(tuple, plain.collect()))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = Tables(spark, folder).kept.groupBy("city_name").agg(F.count("*").alias("n"))
        assert sorted(map(tuple, df.collect())) == expected
        assert "skewed" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_plans_stay_on_the_jvm_and_push_filters(spark):
    tables = Tables(spark, SF_DIR)
    plan = tables.clean.where(F.col("parameter_name") == "click")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event" in plan or "In(event_type, [click" in plan
    assert "Python" not in plan
    bulk = Tables(spark, SF_DIR).bulk_cells._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in bulk and "CartesianProduct" not in bulk and "BroadcastNestedLoopJoin" not in bulk
    assert len(LINES) == 4


def test_partitioned_writes_sort_no_rows(spark, tmp_path):
    spark.sql(f"CREATE TABLE by_month (value BIGINT, month INT) USING parquet PARTITIONED BY (month) LOCATION '{tmp_path / 'table'}'")
    try:
        plan = spark.sql("EXPLAIN INSERT INTO by_month SELECT id, CAST(id % 12 AS INT) FROM range(100)").first()[0]
        assert "Insert" in plan and "Sort" not in plan
    finally:
        spark.sql("DROP TABLE by_month")
    # More directories than open files: the rest is sorted, and nothing is lost.
    rows = spark.range(3000).select("id", F.lit(2024).alias("year"), (F.col("id") % 150).cast("int").alias("month"))
    incremental.publish_missing(rows.coalesce(1), str(tmp_path / "tree"))
    found = spark.read.parquet(str(tmp_path / "tree"))
    assert {(r.id, r.month) for r in found.collect()} == {(i, i % 150) for i in range(3000)}
