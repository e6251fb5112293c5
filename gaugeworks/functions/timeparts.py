"""Calendar parts of naive local timestamps; no expression here depends on a time zone."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def parse_timestamp(text: Column) -> Column:
    """Text in the canonical format to a naive timestamp; anything else is NULL."""
    return F.when(text.rlike(_TIMESTAMP_SHAPE), text.try_cast("timestamp_ntz"))


def format_timestamp(ts: Column) -> Column:
    """Canonical text, to the second (date_format would pass through the session time zone)."""
    return F.substring(ts.cast("string"), 1, 19)


def hour_start(ts: Column) -> Column:
    """Truncate to the hour (date_trunc would answer in the session time zone)."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


def day_of(ts: Column) -> Column:
    return ts.cast("date")


def block_of_day(ts: Column, hours: int = 8) -> Column:
    """Index of the fixed block of the day a timestamp falls in."""
    return F.floor(F.hour(ts) / F.lit(hours)).cast("int")


def time_parts(ts: Column) -> list[Column]:
    return [F.year(ts).alias("year"), F.month(ts).alias("month"),
            F.dayofmonth(ts).alias("day"), F.hour(ts).alias("hour")]


def text_time_parts(text: Column) -> list[Column]:
    """The same parts cut out of canonical timestamp text by position."""
    return [F.substring(text, start, length).try_cast("int").alias(name)
            for name, start, length in
            (("year", 1, 4), ("month", 6, 2), ("day", 9, 2), ("hour", 12, 2))]
