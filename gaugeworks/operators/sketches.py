"""Sketches that are kept per month and merged upward: quantiles and distinct stations.

A quantile sketch answers within a rank error that depends on its size only, a station sketch
counts exactly up to its nominal size and within a relative error beyond.  Both are merged
without looking at readings again, so a year is its twelve months and a network its cities.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of quantile sketches: larger is more exact and larger.
QUANTILE_SIZE = 400
# Base-two logarithm of the number of stations up to which a station sketch is exact.
STATION_SIZE = 12
MONTH = ("year", "month")
CITY_METRIC = ("city_name", "parameter_name")


def rank_bound(size: int = QUANTILE_SIZE) -> float:
    """A rank error no answer exceeds in practice: twice the one published for 99 of 100 answers."""
    return 2 * 2.296 / size ** 0.9021


def quantile_states(readings: DataFrame, by: tuple[str, ...] = (*CITY_METRIC, *MONTH),
                    size: int = QUANTILE_SIZE) -> DataFrame:
    """One sketch of the readings per group; built map-side, so the shuffle carries sketches."""
    return readings.groupBy(*by).agg(F.kll_sketch_agg_double("reading", size).alias("sketch"))


def merge_quantiles(states: DataFrame, by: tuple[str, ...] = CITY_METRIC) -> DataFrame:
    """Sketches of a finer grouping to those of a coarser one."""
    return states.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles_of(states: DataFrame, shares: dict[str, float]) -> DataFrame:
    """The groups with their count and one column per wanted quantile."""
    groups = [c for c in states.columns if c != "sketch"]
    return states.select(*groups, F.kll_sketch_get_n_double("sketch").alias("n"),
                         *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name)
                           for name, p in shares.items()])


def rank_errors(readings: DataFrame, estimates: DataFrame, shares: dict[str, float],
                by: tuple[str, ...] = CITY_METRIC) -> DataFrame:
    """How far each estimate's exact rank is from the wanted one, as a share of the group.

    An estimate that equals several readings has a range of ranks; the nearest one counts.
    """
    keyed = estimates.select(*[F.col(c).alias(f"_{c}") for c in by], *[F.col(q).alias(f"_q_{q}") for q in shares])
    on = [readings[c].eqNullSafe(F.col(f"_{c}")) for c in by]
    joined = readings.join(keyed, on)
    n = F.count("reading")
    counts = joined.groupBy(*by).agg(n.alias("n"), *[x for q in shares for x in (
        F.count_if(F.col("reading") < F.col(f"_q_{q}")).alias(f"_below_{q}"),
        F.count_if(F.col("reading") <= F.col(f"_q_{q}")).alias(f"_upto_{q}"))])

    def error(q: str, p: float) -> Column:
        below, upto = (F.col(f"_{side}_{q}") / F.col("n") for side in ("below", "upto"))
        return F.greatest(below - F.lit(p), F.lit(p) - upto, F.lit(0.0)).alias(f"{q}_rank_error")

    return counts.select(*by, "n", *[error(q, p) for q, p in shares.items()])


def station_states(readings: DataFrame, by: tuple[str, ...] = MONTH, size: int = STATION_SIZE) -> DataFrame:
    """One sketch of the stations per group."""
    return readings.groupBy(*by).agg(F.theta_sketch_agg("station_id", size).alias("stations"))


def merge_stations(states: DataFrame, by: tuple[str, ...] = ("year",), size: int = STATION_SIZE) -> DataFrame:
    """The union of finer groups' stations."""
    return states.groupBy(*by).agg(F.theta_union_agg("stations", size).alias("stations"))


def stations_and_stayers(years: DataFrame) -> DataFrame:
    """Per year: distinct stations, and those that the year before had, too."""
    before = years.select((F.col("year") + 1).alias("_year"), F.col("stations").alias("_before"))
    stayed = F.theta_sketch_estimate(F.theta_intersection("stations", "_before"))
    return years.join(before, F.col("year") == F.col("_year"), "left").select(
        "year", F.theta_sketch_estimate("stations").alias("stations"), F.coalesce(stayed, F.lit(0)).alias("stayed"))
