"""Correlation from mergeable states: counts, means and co-moments per station and metric pair.

A state of a pair (a, b) over rows that have both is (n, mean of a, mean of b, sum of squared
deviations of a and of b, sum of their products).  States are made once from the wide table;
a network's, a state's or a city's correlation, or that of any set of months, comes from
merging them.  Deviations are taken from the merged means, never from zero, so large means
cost no digits.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.model import MetricSpec

PAIR = "pair"
PARTS = ("n", "mean_a", "mean_b", "m2_a", "m2_b", "c_ab")
# Deviations below this share of the mean are rounding, so the column is constant.
CONSTANT = 1e-12


def pair_states(wide: DataFrame, spec: MetricSpec, keys: list[str]) -> DataFrame:
    """One row per key and pair that occurs together, from one aggregate over the wide table."""
    states, unfolded = [], []
    for i, (a, b) in enumerate(spec.pairs()):
        x, y = F.col(a.column), F.col(b.column)
        x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        n = F.count(x)
        states.append(F.struct(
            F.lit(f"{a.name}-{b.name}").alias(PAIR), n.alias("n"), F.avg(x).alias("mean_a"),
            F.avg(y).alias("mean_b"), (F.var_pop(x) * n).alias("m2_a"), (F.var_pop(y) * n).alias("m2_b"),
            (F.covar_pop(x, y) * n).alias("c_ab")).alias(f"_{i}"))
        unfolded.append(F.col(f"_{i}"))
    return (wide.groupBy(*keys).agg(*states).select(*keys, F.inline(F.array(*unfolded)))
            .where(F.col("n") > 0))


def merge_pairwise(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Two tables of states with one row per key and pair to one: what a new load adds.

    The pairwise formula: with d the difference of the means, the merged sum of products is
    c1 + c2 + d_a d_b n1 n2 / (n1 + n2).
    """
    by = [*keys, PAIR]
    other = right.select(*[F.col(c).alias(f"_{c}") for c in [*by, *PARTS]])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    both = left.join(other, same, "full")
    n1, n2 = F.coalesce("n", F.lit(0)), F.coalesce("_n", F.lit(0))
    n = n1 + n2
    shift_a, shift_b = F.col("_mean_a") - F.col("mean_a"), F.col("_mean_b") - F.col("mean_b")

    def mean(c: str, shift: Column) -> Column:
        return F.coalesce(F.col(c) + shift * (n2 / n), F.col(c), F.col(f"_{c}")).alias(c)

    def moment(c: str, product: Column) -> Column:
        return F.coalesce(F.col(c) + F.col(f"_{c}") + product * (n1 * (n2 / n)), F.col(c), F.col(f"_{c}")).alias(c)

    return both.select(*[F.coalesce(c, f"_{c}").alias(c) for c in by], n.alias("n"),
                       mean("mean_a", shift_a), mean("mean_b", shift_b), moment("m2_a", shift_a * shift_a),
                       moment("m2_b", shift_b * shift_b), moment("c_ab", shift_a * shift_b))


def roll_up(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of a finer key merged to a coarser one.

    The merged means first, then every state's own moments plus those of its means around the
    merged ones.  Both aggregates combine map-side; with no key the means are one row per pair.
    """
    by = [*keys, PAIR]
    means = states.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(
        F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean_a")) / F.sum("n")).alias("_mean_a"),
        (F.sum(F.col("n") * F.col("mean_b")) / F.sum("n")).alias("_mean_b"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    a, b = F.col("mean_a") - F.col("_mean_a"), F.col("mean_b") - F.col("_mean_b")
    around = states.join(means if keys else F.broadcast(means), same)
    return around.groupBy(*by).agg(
        F.sum("n").alias("n"), F.max("_mean_a").alias("mean_a"), F.max("_mean_b").alias("mean_b"),
        F.sum(F.col("m2_a") + F.col("n") * a * a).alias("m2_a"),
        F.sum(F.col("m2_b") + F.col("n") * b * b).alias("m2_b"),
        F.sum(F.col("c_ab") + F.col("n") * a * b).alias("c_ab"))


def with_correlation(states: DataFrame) -> DataFrame:
    """Add ``correlation``; NULL where a column of the pair is constant."""
    def spread(c: str) -> Column:
        size = CONSTANT * F.abs(F.col(f"mean_{c}"))
        return F.when(F.col(f"m2_{c}") > F.col("n") * size * size, F.sqrt(f"m2_{c}")).otherwise(0.0)

    r = F.try_divide("c_ab", spread("a") * spread("b"))
    # Rounding can lead a hair beyond one; least and greatest alone would skip a NULL.
    return states.withColumn("correlation", F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))))


def correlation_levels(stations: DataFrame, digits: int | None = 6) -> DataFrame:
    """(level, state_name, city_name, pair, n, correlation) for network, states and cities.

    ``stations`` holds states by station, ``state_name`` and ``city_name``; each level is merged
    from the one below it.  Stage it when it is not a stored table, since the levels share it.
    """
    city = roll_up(stations, ["state_name", "city_name"])
    state = roll_up(city, ["state_name"])
    levels = {"city": city, "state": state, "network": roll_up(state, [])}
    r = F.col("correlation") if digits is None else F.round("correlation", digits)
    return reduce(DataFrame.unionByName, [
        with_correlation(df).select(
            F.lit(level).alias("level"),
            *[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c)
              for c in ("state_name", "city_name")], PAIR, "n", r.alias("correlation"))
        for level, df in levels.items()])
