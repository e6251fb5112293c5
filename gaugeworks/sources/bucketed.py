"""Tables laid out for joins that move nothing: dealt by the join key into the same buckets."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

BUCKETS = 64


def write_bucketed(df: DataFrame, name: str, path: str, by: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Replace a table with ``df`` bucketed and sorted by ``by``, and return it.

    Rows are dealt as the buckets are, so each bucket is one sorted file; a bucket that one key
    outgrows calls for a longer key, see :func:`joined`.
    """
    (df.repartition(buckets, *by).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *by).sortBy(*by).saveAsTable(name))
    return df.sparkSession.table(name)


def joined(tables: list[DataFrame], by: list[str], how: str = "inner") -> DataFrame:
    """Bucketed tables joined on the columns they are bucketed by, without an exchange.

    The hint asks for a merge join: buckets of both sides are read side by side.  For
    station-hours bucket by station and time, so that no station fills a bucket.
    """
    return reduce(lambda a, b: a.join(b.hint("merge"), by, how), tables)
