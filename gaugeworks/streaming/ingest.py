"""Incremental load as a file stream: only files not seen before are read."""
from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.functions.timeparts import time_parts
from gaugeworks.model import RAW_SCHEMA, MetricSpec
from gaugeworks.operators.clean import kept_readings


def load_new_files(spark: SparkSession, source: str, target: str, checkpoint: str,
                   spec: MetricSpec, schema: T.StructType = RAW_SCHEMA,
                   max_files: int | None = None) -> StreamingQuery:
    """Append the kept readings of new Parquet files to a partitioned tree, then stop.

    The checkpoint folder remembers which files are in, and the sink's log makes
    each batch visible once and whole, so a restarted load neither skips nor
    repeats a file.  ``max_files`` bounds a batch, not the load.
    """
    stream = spark.readStream.schema(schema)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    kept = kept_readings(stream.parquet(source), spec)
    return (kept.select("*", *time_parts(F.col("collected_at"))).writeStream.format("parquet")
            .option("path", target).option("checkpointLocation", checkpoint)
            .partitionBy("year", "month").trigger(availableNow=True).start())
