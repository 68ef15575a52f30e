"""Small column and value transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def type_number(kind: Column, prefix: str = "type_") -> Column:
    """The number after ``prefix``; null when it is missing or not a number."""
    return F.regexp_extract(kind, f"{prefix}(.*)$", 1).try_cast("int")


def round_scaled(value: Column, scale: int = 100, digits: int = 2) -> Column:
    """``value * scale`` rounded."""
    return F.round(value * scale, digits)


def remap_values(df: DataFrame, mapping: dict, subset: list[str]) -> DataFrame:
    """Replace values by a dictionary in the named columns only."""
    return df.na.replace(mapping, subset=subset)


def full_name(first: Column, last: Column) -> Column:
    """First and last name with a blank between; null when either is null."""
    return F.concat(first, F.lit(" "), last)
