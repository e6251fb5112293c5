"""Publishing results and intermediate relations."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Column

from gaugeworks.session import ROW_GROUP_BYTES

ROWS_PER_PART = 1_000_000


def write_tree(df: DataFrame, root: str, partitions: tuple[str, ...] = ("year", "month")) -> str:
    """A hive-style partitioned Parquet tree.

    The rebalance hint groups rows by directory so that tasks do not each write
    a sliver of every month, and splits a month that outgrows one task.
    """
    (df.hint("rebalance", *partitions).write.mode("overwrite")
     .option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(*partitions).parquet(root))
    return root


def write_csv_parts(df: DataFrame, path: str, rows_per_part: int = ROWS_PER_PART) -> str:
    """Delimited parts with a header each and a bounded number of rows."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("maxRecordsPerFile", rows_per_part)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    return path


def write_headerless_csv(df: DataFrame, path: str, columns: list[str], sep: str = ",") -> str:
    """Header-less delimited files in a pinned column order."""
    (df.select(*columns).write.mode("overwrite").option("sep", sep).option("escape", '"')
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    return path


def write_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace the content of a table and return it."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_ordered_file(df: DataFrame, path: str, *order: Column, header: bool = True) -> str:
    """One sorted file, for an aggregated result small enough to be read by people.

    Only ever call this on an aggregate: the last step runs in one task.
    """
    (df.orderBy(*order).coalesce(1).write.mode("overwrite")
     .option("header", header).csv(path))
    return path
