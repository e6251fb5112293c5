"""Scans over the file layouts readings arrive in."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.model import CSV_COLUMNS, CSV_SCHEMA


def parse_months(text: str) -> list[int]:
    """'1-12', '1,2,3' or '7' to sorted distinct month numbers."""
    months: set[int] = set()
    for part in text.split(","):
        first, _, last = part.strip().partition("-")
        months.update(range(int(first), int(last or first) + 1))
    if not months or min(months) < 1 or max(months) > 12:
        raise ValueError(f"months must lie in 1..12: {text!r}")
    return sorted(months)


def read_tree(spark: SparkSession, root: str, months: str | None = None,
              columns: list[str] | None = None) -> DataFrame:
    """A ``year=/month=`` Parquet tree as one relation.

    The month list becomes a partition filter and the column list the read
    schema, so unselected directories and columns are never opened.
    """
    df = spark.read.parquet(root)
    if months is not None:
        df = df.where(F.col("month").isin(parse_months(months)))
    return df.select(*columns) if columns else df


def read_tree_when(spark: SparkSession, root: str, calendar: DataFrame,
                   keys: tuple[str, ...] = ("year", "month"), columns: list[str] | None = None) -> DataFrame:
    """The part of a tree whose partitions a relation names, for choices that are data themselves.

    ``calendar`` has one row per partition to read (repeated ones count once).  The join is on
    partition columns, so its keys prune directories while the query runs: only files of named
    partitions are opened.
    """
    tree = spark.read.parquet(root)
    if columns:
        tree = tree.select(*dict.fromkeys([*columns, *keys]))
    wanted = calendar.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    on = [F.col(k) == F.col(f"_{k}") for k in keys]
    found = tree.join(wanted, on).drop(*[f"_{k}" for k in keys])
    return found.select(*columns) if columns else found


def read_csv_parts(spark: SparkSession, path: str,
                   schema: T.StructType = CSV_SCHEMA) -> DataFrame:
    """Delimited parts that each carry a header, with quoted fields honoured."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def read_headerless_csv(spark: SparkSession, path: str, schema: T.StructType,
                        sep: str = ",") -> DataFrame:
    return (spark.read.schema(schema).option("sep", sep).option("escape", '"')
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def read_csv_flagging(spark: SparkSession, path: str,
                      schema: T.StructType = CSV_SCHEMA) -> DataFrame:
    """Like :func:`read_csv_parts`, with the text of every ill-formed row in ``_bad_row``."""
    flagged = T.StructType([*schema.fields, T.StructField("_bad_row", T.StringType())])
    return (spark.read.schema(flagged).option("header", True).option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad_row").csv(path))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every physical line, headers included, for row-level auditing."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def split_lines(lines: DataFrame, columns: list[str] = CSV_COLUMNS) -> DataFrame:
    """Cut raw lines at every comma; lines with too few fields are marked, not dropped.

    The split sits in a one-element explode: a filter on a field is not moved
    below a generator, so each line is cut once instead of once per condition.
    """
    fields = F.explode(F.array(F.split(F.col("line"), ",", -1)))
    return (lines.select(fields.alias("_fields"))
            .select((F.size("_fields") < len(columns)).alias("malformed"),
                    *[F.get("_fields", F.lit(i)).alias(c) for i, c in enumerate(columns)]))


def bind_external(spark: SparkSession, name: str, path: str, schema: T.StructType,
                  sep: str = ",") -> DataFrame:
    """Bind a directory of header-less delimited files as an external table.

    Dropping or rebinding the table never touches the files.  ``name`` is one
    identifier; a table that already has it is replaced only if it is external.
    """
    quoted = "`" + name.replace("`", "``") + "`"
    if spark.catalog.tableExists(quoted):
        if spark.catalog.getTable(quoted).tableType != "EXTERNAL":
            raise ValueError(f"{name} is a table with data of its own")
        spark.sql(f"DROP TABLE {quoted}")
    spark.catalog.createTable(quoted, path=path, source="csv", schema=schema, sep=sep,
                              timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    return spark.table(quoted)


def file_inventory(df: DataFrame) -> DataFrame:
    """Rows and bytes per file behind a file-based relation."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size"))
            .groupBy("file_path", "file_size").agg(F.count("*").alias("rows")))


def header_report(spark: SparkSession, path: str, expected: list[str] = CSV_COLUMNS,
                  pattern: str = "*.csv") -> DataFrame:
    """For each delimited file, whether its first line is the expected header and no other is.

    Files may be split across tasks.  Lines have rising numbers within the part of a
    file one task reads, so the part's offset and that number tell which is first; all
    of it is a map-side aggregate.
    """
    header = ",".join(expected)
    lines = (spark.read.option("pathGlobFilter", pattern).text(path)
             .select(F.col("_metadata.file_path").alias("file_path"),
                     F.struct(F.col("_metadata.file_block_start"),
                              F.monotonically_increasing_id()).alias("place"),
                     (F.col("value") == header).alias("is_header")))
    return (lines.groupBy("file_path")
            .agg(F.count_if("is_header").alias("header_lines"), F.count("*").alias("lines"),
                 F.min_by("is_header", "place").alias("on_first_line"))
            .withColumn("conforms", (F.col("header_lines") == 1) & F.col("on_first_line")))
