"""Load only the partitions a target does not hold yet."""
from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import ROW_GROUP_BYTES

PARTITIONS = ("year", "month")
# Fixed value: the directory name Spark gives a missing key.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def present_partitions(spark: SparkSession, target: str,
                       keys: tuple[str, ...] = PARTITIONS) -> list[tuple[str | None, ...]]:
    """Partition keys already published, as text, from the names of their directories.

    Only the file listing is read, which Spark's reader makes anyway; a partition
    is one entry, however many files it has.
    """
    try:
        files = spark.read.parquet(target).inputFiles()
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        raise
    found = {tuple(_value(file, key) for key in keys) for file in files}
    return sorted(found, key=lambda values: tuple((v is not None, v or "") for v in values))


def _value(file: str, key: str) -> str | None:
    """The value of a key in a path with ``key=value`` directories."""
    part = next(p for p in file.split("/")[:-1] if p.startswith(f"{key}="))
    value = unquote(part.partition("=")[2])
    return None if value == NO_VALUE else value


def missing_rows(source: DataFrame, target: str,
                 keys: tuple[str, ...] = PARTITIONS) -> DataFrame:
    """Source rows whose partition is not in the target.

    The condition compares partition columns with constants, so a source that is
    laid out by the same keys does not open the partitions already published.
    """
    wanted = source
    for values in present_partitions(source.sparkSession, target, keys):
        same = [F.col(k).eqNullSafe(F.lit(v).cast(source.schema[k].dataType)) for k, v in zip(keys, values)]
        wanted = wanted.where(~reduce(Column.__and__, same))
    return wanted


def publish_missing(source: DataFrame, target: str, keys: tuple[str, ...] = PARTITIONS) -> None:
    """Write the missing partitions; present ones are left as they are.

    Nothing is shuffled or sorted: rows are written where they are read, so a hot month
    is written by as many tasks as read it, each with a file open per month.  Dynamic
    overwrite moves staged files in only when the job commits: a failed load
    publishes nothing and can be repeated.
    """
    rows = missing_rows(source, target, keys)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(*keys).parquet(target))
