"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 4) choose
the data and the cores.  All queries run once to warm up and then three times
each; the median counts.  Results go to a sink that reads every row and keeps none.
"""
from __future__ import annotations

import json
import os
import statistics
import time

from gaugeworks.plans.catalog import QUERIES
from gaugeworks.session import build_session
from gaugeworks.sources.benchmark_tables import SAMPLE_PARTITIONS

# Query and the relation whose rows it reads.
HEADLINE = {
    "q1_row_audit": "events", "a4_city_ranking": "events", "a6_state_ranking": "events",
    "a9_hourly_profile": "events", "a27_network_exceedance": "events",
    "a28_exceedance_by_city": "events", "q12_completeness": "events",
    "a13_city_metric_summary": "readings", "a15_average_duplicates": "readings",
    "a16_pivot_mean": "readings", "a8_monthly_means": "readings",
    "a11_population_statistics": "readings", "a12_sample_statistics": "readings",
    "a22_station_features_bulk": "readings", "d2_correlation_pairs_bulk": "readings",
    "f21_upper_trim": "readings", "r4_density_histogram": "readings",
    "m3_best_of_restarts": "events",
}


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    spark = build_session("bench", f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          **{"spark.ui.enabled": "false", "spark.driver.memory": "5g",
                             SAMPLE_PARTITIONS: str(cpus)})
    spark.sparkContext.setLogLevel("ERROR")
    rows = {"events": spark.read.parquet(f"{folder}/events.parquet").count(),
            # Four measures a line item; the third line has no tax reading.
            "readings": spark.read.parquet(f"{folder}/lineitem.parquet").selectExpr(
                "sum(IF(l_linenumber = 3, 3, 4)) AS n").first()["n"]}
    seconds, rates = {}, {}
    for name in HEADLINE:
        run(QUERIES[name], spark, folder)
    for name, relation in HEADLINE.items():
        seconds[name] = round(statistics.median(
            run(QUERIES[name], spark, folder) for _ in range(3)), 3)
        rates[name] = round(rows[relation] / seconds[name])
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "rows_per_sec": rates,
                      "input_rows": rows, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
