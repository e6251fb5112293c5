"""Parsing, location defaults and unit conversion for one reading."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeworks.model import UNIT_FACTORS, UNKNOWN

# Fixed value: plain decimal notation, no exponent, no leading dot.
STRICT_NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"


def is_strict_number(text: Column) -> Column:
    return F.coalesce(text.rlike(STRICT_NUMBER), F.lit(False))


def strict_number(text: Column) -> Column:
    """The number, only if it is written in plain decimal notation."""
    return F.when(is_strict_number(text), text.try_cast("double"))


def finite(value: Column) -> Column:
    """NaN and infinities become NULL: they are gaps, and would poison every mean."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def lenient_number(text: Column) -> Column:
    """The number in any notation, surrounding blanks allowed; NULL if there is none."""
    return finite(F.trim(text).try_cast("double"))


def or_unknown(text: Column, default: str = UNKNOWN) -> Column:
    """The trimmed label, or the default for a missing or blank one."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(default))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def to_canonical_unit(value: Column, unit: Column, factors=UNIT_FACTORS) -> Column:
    """Multiply by the factor of the first matching unit prefix; an unknown unit keeps its value."""
    result = value
    for prefix, factor in reversed(factors):
        result = F.when(unit.startswith(prefix), value * F.lit(factor)).otherwise(result)
    return result
