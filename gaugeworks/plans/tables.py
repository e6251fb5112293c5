"""The provided tables as the relations the queries start from."""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.model import DAILY, Metric, MetricSpec
from gaugeworks.operators import clean, exceed, reshape, summaries
from gaugeworks.session import fresh_path, tolerate_skew
from gaugeworks.sources import benchmark_tables as bench
from gaugeworks.sources.readers import split_lines

EVENTS = bench.EVENT_SPEC
LINES = bench.LINE_SPEC
# The same metrics and one that no reading has.
EVENTS_AND_SILENT = MetricSpec((*EVENTS, Metric("silent", "silent", 5, "1-hour", 4, DAILY, 10)))

# A floor these tables can meet: a year of readings has thousands of hours per station, they a dozen.
MIN_HOURS = 10

# Distance between planted groups of stations, far above the spread of any feature.
PLANTED_APART = 20_000.0


class Tables:
    """Lazy relations over one folder; each is built at most once per query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tolerate_skew(spark), folder

    def staged(self, df: DataFrame) -> DataFrame:
        """Write a relation that several passes read to the shared folder, and scan it from there."""
        path = fresh_path(self.spark, "staged")
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def table(self, name: str) -> DataFrame:
        return bench.table(self.spark, self.folder, name)

    @cached_property
    def raw(self) -> DataFrame:
        return bench.event_readings(self.spark, self.folder)

    @cached_property
    def kept(self) -> DataFrame:
        return clean.kept_readings(self.raw, EVENTS, padded=False)

    @cached_property
    def clean(self) -> DataFrame:
        return clean.clean_long(self.raw, EVENTS, padded=False)

    @cached_property
    def hours(self) -> DataFrame:
        return reshape.located_hours(self.kept, EVENTS)

    @cached_property
    def wide(self) -> DataFrame:
        """Station-hours by mean, with attributes and calendar parts."""
        return reshape.wide_table(reshape.merge_locations(self.hours, EVENTS), self.attributes, EVENTS)

    @cached_property
    def daily(self) -> DataFrame:
        """Station-days by mean: the grain at which metrics of this data coincide."""
        return reshape.daily_means(reshape.merge_locations(self.hours, EVENTS), EVENTS)

    @cached_property
    def city_counts(self) -> DataFrame:
        return exceed.city_counts(reshape.merge_locations(self.hours, EVENTS), EVENTS,
                                  attributes=self.attributes)

    @cached_property
    def attributes(self) -> DataFrame:
        """One row per station, from the located hours rather than a second scan."""
        return clean.station_attributes(self.hours)

    @cached_property
    def features(self) -> DataFrame:
        return summaries.station_features(self.daily, EVENTS, MIN_HOURS)

    @cached_property
    def text_lines(self) -> DataFrame:
        return bench.event_lines(self.spark, self.folder)

    @cached_property
    def text_rows(self) -> DataFrame:
        return split_lines(self.text_lines)

    @cached_property
    def bulk_raw(self) -> DataFrame:
        return bench.line_readings(self.spark, self.folder)

    @cached_property
    def bulk_kept(self) -> DataFrame:
        return clean.kept_readings(self.bulk_raw, LINES, padded=False)

    @cached_property
    def _bulk_spread(self) -> DataFrame:
        """The kept bulk readings for plans whose first shuffle is preceded by much work."""
        partitions = int(self.spark.conf.get(bench.SAMPLE_PARTITIONS, "0"))
        return clean.kept_readings(bench.line_readings(self.spark, self.folder, partitions), LINES,
                                   padded=False)

    @cached_property
    def bulk_clean(self) -> DataFrame:
        """For queries about one metric."""
        return clean.clean_long(self.bulk_raw, LINES, padded=False)

    @cached_property
    def bulk_table(self) -> DataFrame:
        """For queries about all metrics."""
        return clean.clean_table(self._bulk_spread, LINES)

    @cached_property
    def bulk_hours(self) -> DataFrame:
        return reshape.located_hours(self._bulk_spread, LINES)

    @cached_property
    def bulk_cells(self) -> DataFrame:
        return reshape.merge_locations(self.bulk_hours, LINES)

    @cached_property
    def bulk_wide(self) -> DataFrame:
        return reshape.wide_table(self.bulk_cells, clean.station_attributes(self.bulk_kept), LINES)

    @cached_property
    def planted(self) -> DataFrame:
        """Bulk station features moved into three groups far apart, by the station's number."""
        shift = (F.col("station_id") % 3) * F.lit(PLANTED_APART)
        return self.bulk_features.withColumns({c: F.col(c) + shift for c in LINES.averages})

    @cached_property
    def bulk_features(self) -> DataFrame:
        return summaries.station_features(self.bulk_cells, LINES, MIN_HOURS)
