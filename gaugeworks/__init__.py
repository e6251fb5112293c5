"""gaugeworks: analytics over long-format sensor readings, as Spark DataFrame operators.

A readings table has one row per station x metric x timestamp.  Everything here
is a plain function from DataFrame to DataFrame; nothing runs until the caller
asks for an action (model fitting and file publishing excepted).
"""
from gaugeworks.model import AIR_QUALITY, Metric, MetricSpec

__all__ = ["AIR_QUALITY", "Metric", "MetricSpec"]
