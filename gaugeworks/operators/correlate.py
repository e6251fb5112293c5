"""Pairwise correlation of metrics over the wide table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.statistics import pearson
from gaugeworks.model import MetricSpec


def _label(a, b) -> str:
    return f"{a.name}-{b.name}"


def _all_pairs(wide: DataFrame, spec: MetricSpec) -> DataFrame:
    """One row, one column per metric pair: every coefficient from a single scan."""
    return wide.agg(*[pearson(F.col(a.column), F.col(b.column)).alias(_label(a, b))
                      for a, b in spec.pairs()])


def correlation_pairs(wide: DataFrame, spec: MetricSpec, digits: int | None = 6) -> DataFrame:
    """(pair, correlation) for every unordered pair, strongest positive first."""
    row = _all_pairs(wide, spec)
    pairs = row.unpivot([], [f"`{c}`" for c in row.columns], "pair", "correlation")
    if digits is not None:
        pairs = pairs.withColumn("correlation", F.round("correlation", digits))
    return pairs.orderBy(F.desc_nulls_last("correlation"), "pair")


def correlation_cells(wide: DataFrame, spec: MetricSpec, digits: int | None = 6) -> DataFrame:
    """The full matrix as (row_metric, column_metric, correlation), diagonal included."""
    row = _all_pairs(wide, spec)
    cells = [(m, m, F.lit(1.0)) for m in spec]
    for a, b in spec.pairs():
        r = F.col(f"`{_label(a, b)}`")
        r = r if digits is None else F.round(r, digits)
        cells += [(a, b, r), (b, a, r)]
    stacked = F.array(*[F.struct(F.lit(i.name).alias("row_metric"),
                                 F.lit(j.name).alias("column_metric"), r.alias("correlation"))
                        for i, j, r in cells])
    return row.select(F.inline(stacked))


def correlation_matrix(wide: DataFrame, spec: MetricSpec, digits: int | None = 6) -> DataFrame:
    """The symmetric matrix: one row per metric, one column per metric."""
    return (correlation_cells(wide, spec, digits).groupBy(F.col("row_metric").alias("metric"))
            .agg(*[F.max(F.when(F.col("column_metric") == m.name, F.col("correlation")))
                   .alias(m.name) for m in spec]))


def strongest_pairs(pairs: DataFrame, positive: int = 5, negative: int = 3) -> DataFrame:
    """The most positive and the most negative pairs."""
    top = (pairs.where(F.col("correlation").isNotNull())
           .orderBy(F.desc("correlation"), "pair").limit(positive)
           .withColumn("end", F.lit("positive")))
    bottom = (pairs.where(F.col("correlation").isNotNull())
              .orderBy(F.asc("correlation"), "pair").limit(negative)
              .withColumn("end", F.lit("negative")))
    return top.unionByName(bottom)
