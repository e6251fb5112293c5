"""Reconciliation of two tables that should be equal: find the groups that differ, then the rows.

Every group gets an order-free checksum of its rows, so two large tables are compared by one
short row per group.  Only rows of differing groups go on, and there rows are compared as
multisets: a row that is twice on one side and once on the other is reported once.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def checksums(df: DataFrame, keys: dict[str, Column], columns: list[str]) -> DataFrame:
    """Rows, sum and exclusive-or of row hashes per group.

    The two use hashes with different seeds: equal rows cancel in an exclusive-or, sums of
    large and small hashes may meet, both at once do not by chance.
    """
    row = [F.col(c) for c in columns]
    return df.groupBy(*[key.alias(name) for name, key in keys.items()]).agg(
        F.count("*").alias("rows"),
        F.sum(F.xxhash64(*row).cast("decimal(20,0)")).alias("hash_sum"),
        F.bit_xor(F.xxhash64(F.lit(1), *row)).alias("hash_xor"))


def differing_groups(left: DataFrame, right: DataFrame, keys: dict[str, Column], columns: list[str]) -> DataFrame:
    """Groups whose rows differ, with the rows of either side (NULL where a side has none)."""
    marks = ["rows", "hash_sum", "hash_xor"]
    a = checksums(left, keys, columns)
    b = checksums(right, keys, columns)
    b = b.select(*[F.col(c).alias(f"_{c}") for c in b.columns])
    same_key = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    same = reduce(Column.__and__, [F.col(m).eqNullSafe(F.col(f"_{m}")) for m in marks])
    return a.join(b, same_key, "full").where(~same).select(
        *[F.when(F.col("rows").isNotNull(), F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys],
        F.col("rows").alias("left_rows"), F.col("_rows").alias("right_rows"))


def differing_rows(left: DataFrame, right: DataFrame, groups: DataFrame, keys: dict[str, Column],
                   columns: list[str]) -> DataFrame:
    """Rows of the given groups that one side has more often: the row, ``side`` and ``surplus``.

    ``groups`` comes from :func:`differing_groups`; stage it, since both sides read it.
    """
    wanted = groups.select(*[F.col(k).alias(f"_g_{k}") for k in keys])
    in_group = [key.eqNullSafe(F.col(f"_g_{name}")) for name, key in keys.items()]

    def side(df: DataFrame, weight: int) -> DataFrame:
        return (df.select(*columns).join(wanted, in_group, "left_semi")
                .withColumn("_weight", F.lit(weight)))

    counted = side(left, 1).unionByName(side(right, -1)).groupBy(*columns).agg(F.sum("_weight").alias("_net"))
    return counted.where(F.col("_net") != 0).select(
        *columns, F.when(F.col("_net") > 0, "left").otherwise("right").alias("side"), F.abs("_net").alias("surplus"))
