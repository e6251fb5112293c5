"""Exact percentiles of groups of any size.

The built-in exact aggregate buffers every distinct value of a group in one
task.  Here values are first counted in narrow order-preserving buckets, which
combines before the shuffle; then only the buckets that hold a wanted rank are
looked into and ranked.  No task ever holds a group.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PER_E_FOLD = 65536
_OFFSET = 50_000_000  # above 745 * 65536, so buckets of positive values stay positive


def value_bucket(value: Column) -> Column:
    """A non-decreasing integer function of the value, about 15 millionths wide."""
    zero = F.lit(0).cast("bigint")
    scale = (F.floor(F.log(F.abs(value)) * _PER_E_FOLD) + _OFFSET).cast("bigint")
    signed = F.when(value > 0, scale).when(value < 0, -scale).otherwise(zero)
    # Never null, so a join on the bucket adds no filter and both readers share one shuffle.
    return F.coalesce(signed, zero)


def percentiles(df: DataFrame, value: str, probabilities: list[float],
                by: list[str] = (), max_groups: int | None = None) -> DataFrame:
    """``by`` columns, ``probability`` and the linearly interpolated ``percentile``.

    ``max_groups`` is a bound the caller can prove, such as the number of
    specified metrics.  It bounds the table of wanted buckets (two per group and
    probability), and giving it asks for that table to be broadcast to a second
    scan of the input.  Without it, equal values are merged into counts first and the counts
    are joined by shuffle, so that a frequent value cannot skew that join.
    """
    by = list(by)
    bounded = max_groups is not None
    present = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    one = F.lit(1).cast("bigint")
    rows = (present.withColumn("_n", one) if bounded
            else present.groupBy(*by, "_v").agg(F.sum(one).alias("_n")))
    rows = rows.withColumn("_bucket", value_bucket(F.col("_v")))

    group = Window.partitionBy(*by)
    upto = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = (rows.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_size"))
               .select(*by, "_bucket", F.sum("_size").over(upto).alias("_end"),
                       F.sum("_size").over(group).alias("_total"), "_size"))
    wanted = (buckets
              .withColumn("_start", F.col("_end") - F.col("_size"))
              .withColumn("probability", F.explode(F.array(*[F.lit(float(p))
                                                             for p in probabilities])))
              .withColumn("_position", F.col("probability") * (F.col("_total") - 1))
              .withColumn("_lo", F.floor("_position")).withColumn("_hi", F.ceil("_position"))
              .where(_holds("_lo") | _holds("_hi"))
              .select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_bucket").alias("_b"),
                      "probability", "_position", "_lo", "_hi", F.col("_start").alias("_base")))

    same = F.col("_bucket") == F.col("_b")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    rank = ["probability", "_position", "_lo", "_hi", "_base", "_bucket"]
    inside = (rows.join(F.broadcast(wanted) if bounded else wanted, same)
              .groupBy(*by, *rank, "_v").agg(F.sum("_n").alias("_n")))
    order = (Window.partitionBy(*by, "probability", "_bucket").orderBy("_v")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (inside.withColumn("_end", F.col("_base") + F.sum("_n").over(order))
              .withColumn("_start", F.col("_end") - F.col("_n")))
    picked = ranked.groupBy(*by, "probability", "_position", "_lo").agg(
        F.max(F.when(_holds("_lo"), F.col("_v"))).alias("_low"),
        F.max(F.when(_holds("_hi"), F.col("_v"))).alias("_high"))
    share = F.col("_position") - F.col("_lo")
    return picked.select(*by, "probability",
                         (F.col("_low") + (F.col("_high") - F.col("_low")) * share)
                         .alias("percentile"))


def _holds(rank: str) -> Column:
    """Whether the half-open rank range of this row contains a zero-based rank."""
    return (F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_end"))
