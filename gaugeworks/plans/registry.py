"""The two dictionaries behind the driver contract."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.plans.oracle import with_shared_relations
from gaugeworks.plans.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# Instead of a number of digits: whole numbers above a thousand, six digits below.
BY_SIZE = -1


def _rounded(name: str, digits: int) -> Column:
    value = F.col(f"`{name}`")
    if digits == BY_SIZE:
        return F.when(F.abs(value) > 1000, F.round(value, 0)).otherwise(F.round(value, 6)).alias(name)
    return F.round(value, digits).alias(name)


def by_size_sql(value: str) -> str:
    return f"CASE WHEN abs({value}) > 1000 THEN round({value}, 0) ELSE round({value}, 6) END"


def rounded(df: DataFrame, digits: int, special: dict[str, int]) -> DataFrame:
    """Round every double, so that sums taken in another order compare equal."""
    return df.select(*[_rounded(name, special.get(name, digits)) if kind == "double"
                       else F.col(f"`{name}`") for name, kind in df.dtypes])


def query(name: str, sql: str | None = None, digits: int = 4, **special: int):
    """Register ``function(tables) -> DataFrame`` and, where there is one, its SQL twin."""
    def register(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, folder: rounded(
            function(Tables(spark, folder)), digits, special)
        if sql is not None:
            ORACLES[name] = with_shared_relations(sql)
        return function
    return register
