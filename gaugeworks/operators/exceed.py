"""Exceedance of limit values at the averaging time each limit is defined for."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.statistics import over_limit, percentage
from gaugeworks.functions.timeparts import block_of_day, day_of
from gaugeworks.model import HOURS_PER_DAY, MetricSpec


def observation_unit(hours: int) -> str:
    """How an observation of an averaging time is called."""
    return "station-days" if hours == HOURS_PER_DAY else f"{hours}-hour blocks"


def with_limits(df: DataFrame, spec: MetricSpec) -> DataFrame:
    """Join each metric's limits; the limit relation has one row per specified metric."""
    limits = F.broadcast(spec.frame(df.sparkSession))
    return df.join(limits, F.col("parameter_name") == F.col("pollutant")).drop("parameter_name")


def window_means(hours: DataFrame, spec: MetricSpec, min_hours: int = 1,
                 attributes: DataFrame | None = None) -> DataFrame:
    """Mean per station, metric and averaging window, from station-hours.

    ``block`` is the index of the window within its day, and NULL for metrics
    limited at a day.  All kinds come out of one aggregate per station-day
    holding a sum and a count for every window, so one shuffle of station-days
    serves all metrics; the windows are unfolded after it.  ``attributes`` has
    one row per station and is joined to the station-days; without it, the
    hours carry their city and state.
    """
    windows, sums = [], []
    for m in spec:
        block = block_of_day(F.col("collected_at"), m.hours)
        for b in ([None] if m.hours == HOURS_PER_DAY else range(HOURS_PER_DAY // m.hours)):
            name = f"{m.short}_{'day' if b is None else b}"
            value = F.col(m.column) if b is None else F.when(block == b, F.col(m.column))
            sums += [F.sum(value).alias(f"_sum_{name}"), F.count(value).alias(f"_n_{name}")]
            windows.append(F.struct(
                F.lit(m.name).alias("parameter_name"), F.lit(b).cast("int").alias("block"),
                F.col(f"_n_{name}").alias("hours"), F.col(f"_sum_{name}").alias("total")))
    place = ["city_name", "state_name"]
    keys = ["station_id", *place, "date"]
    dated = hours.withColumn("date", day_of(F.col("collected_at")))
    if attributes is None:
        days = dated.groupBy(*keys).agg(*sums)
    else:
        days = (dated.groupBy("station_id", "date").agg(*sums)
                .join(attributes.select("station_id", *place), "station_id", "left"))
    return (days.select(*keys, F.inline(F.array(*windows)))
            .where((F.col("hours") > 0) & (F.col("hours") >= min_hours))
            .withColumn("mean", F.col("total") / F.col("hours")))


def city_counts(hours: DataFrame, spec: MetricSpec, min_hours: int = 1,
                attributes: DataFrame | None = None) -> DataFrame:
    """Per city and metric: windows, mean of means, windows above the limit, and plain sums.

    Windows with fewer than ``min_hours`` hours are no observations, but their
    hours stay in the plain sums.  Every exceedance result follows from this
    small table; stage it when several of them are wanted.
    """
    windows = with_limits(window_means(hours, spec, attributes=attributes), spec)
    windows = windows.withColumn("mean", F.when(F.col("hours") >= min_hours, F.col("mean")))
    over = over_limit(F.col("mean"), F.col("standard_ug_m3"))
    return (windows.groupBy("city_name", "state_name", "pollutant", "metric_order",
                            "standard_ug_m3", "averaging_time", "who_2021_ug_m3",
                            "who_averaging_time")
            .agg(F.count("mean").alias("n"), F.avg("mean").alias("mean"),
                 F.count_if(over).alias("over"),
                 F.sum("total").alias("total"), F.sum("hours").alias("hours"))
            .withColumn("pct", percentage(F.col("over"), F.col("n"))))


def city_exceedance(counts: DataFrame, min_observations: int = 30) -> DataFrame:
    """Observations, mean of means, exceedances and their share per city and metric."""
    return (counts.where(F.col("n") >= min_observations)
            .select("city_name", "state_name", "pollutant",
                    F.col("standard_ug_m3").alias("standard"), "n", "mean", "over", "pct"))


def network_exceedance(counts: DataFrame, spec: MetricSpec,
                       min_observations: int = 30) -> DataFrame:
    """One row per specified metric over the whole network, zeros for one that never occurs.

    Totals are taken before the floor, the worst city after it, and the cities
    whose plain mean is above the limit from the sums carried along.
    """
    ranked = F.when(F.col("n") >= min_observations,
                    F.struct((-F.col("pct")).alias("rank"), "city_name", "state_name"))
    above = over_limit(F.try_divide(F.col("total"), F.col("hours")), F.col("standard_ug_m3"))
    units = {m.window: observation_unit(m.hours) for m in spec}
    unit = F.element_at(F.create_map(*[F.lit(x) for kv in units.items() for x in kv]),
                        F.col("averaging_time"))
    seen = counts.groupBy("pollutant").agg(
        F.sum("n").alias("observations"), F.sum("over").alias("exceedances"),
        F.count_if(above).alias("cities_with_mean_above"), F.min(ranked).alias("worst"))
    return (spec.frame(counts.sparkSession).join(seen, "pollutant", "left")
            .na.fill(0, ["observations", "exceedances", "cities_with_mean_above"])
            .select("pollutant", "standard_ug_m3", "averaging_time", "who_2021_ug_m3",
                    "who_averaging_time", "observations", unit.alias("observation_unit"),
                    "exceedances",
                    percentage(F.col("exceedances"), F.col("observations")).alias("pct_above"),
                    "cities_with_mean_above", F.col("worst.city_name").alias("worst_city"),
                    (-F.col("worst.rank")).alias("worst_city_pct_above")))


def exceedance_by_city(cities: DataFrame, spec: MetricSpec) -> DataFrame:
    """One row per city; four columns per metric, NULL where the metric is below the floor."""
    cells = [F.max(F.when(F.col("pollutant") == m.name, F.col(c))).alias(f"{m.name}_{c}")
             for m in spec for c in ("n", "mean", "over", "pct")]
    return cities.groupBy("city_name", "state_name").agg(*cells)


def _pct(m) -> str:
    return f"`{m.name}_pct`"


def with_worst_pct(by_city: DataFrame, spec: MetricSpec) -> DataFrame:
    """Add the largest exceedance share over the metrics, ignoring missing ones."""
    return by_city.withColumn("worst_pct", F.greatest(*[F.col(_pct(m)) for m in spec]))


def worst_cities(by_city: DataFrame, spec: MetricSpec, top: int = 15) -> DataFrame:
    """Cities by their largest exceedance share."""
    return (with_worst_pct(by_city, spec)
            .orderBy(F.desc_nulls_last("worst_pct"), "city_name", "state_name").limit(top))


def with_main_offender(by_city: DataFrame, spec: MetricSpec) -> DataFrame:
    """Add the metric with the largest share; the earlier metric wins a tie, missing counts as -1."""
    candidates = [F.struct(F.coalesce(F.col(_pct(m)), F.lit(-1.0)).alias("pct"),
                           F.lit(-i).alias("back"), F.lit(m.name).alias("name"))
                  for i, m in enumerate(spec)]
    return by_city.withColumn("main_offender", F.greatest(*candidates)["name"])


def exceedance_highlights(cities: DataFrame, top: int = 20) -> DataFrame:
    """The largest city x metric shares with rank, and how many are above zero in all.

    The rank is taken over the rows already limited, and the total is a scalar
    subquery, so neither gathers the full list in one task.
    """
    exceeding = cities.where(F.col("pct") > 0)
    total = exceeding.agg(F.count("*").alias("n")).scalar()
    order = [F.desc("pct"), F.asc("city_name"), F.asc("state_name"), F.asc("pollutant")]
    return (exceeding.orderBy(*order).limit(top)
            .select(F.row_number().over(Window.orderBy(*order)).alias("rank"),
                    "city_name", "state_name", "pollutant", "standard", "mean", "pct",
                    total.alias("exceeding_pairs")))


def thresholds(readings: DataFrame, spec: MetricSpec) -> DataFrame:
    """The limit table for the metrics that occur in the readings."""
    seen = readings.select("parameter_name").distinct()
    return (spec.frame(readings.sparkSession)
            .join(seen, F.col("pollutant") == F.col("parameter_name"), "left_semi")
            .select("pollutant", F.col("standard_ug_m3").alias("naaqs_ug_m3"),
                    F.col("averaging_time").alias("naaqs_averaging_time"),
                    "who_2021_ug_m3", "who_averaging_time"))
