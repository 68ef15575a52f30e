"""Structs, maps and arrays to plain columns and rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_rows(spark: SparkSession, text: str, schema: T.StructType) -> DataFrame:
    """Rows from JSON text: one object, or an array of objects with a row each."""
    one = spark.range(1).select(F.lit(text).alias("text"))
    as_array = F.from_json("text", T.ArrayType(schema))
    return one.select(F.inline(as_array))


def struct_columns(df: DataFrame, name: str) -> list[Column]:
    """The fields of struct column ``name`` as columns, read off the schema."""
    return [F.col(name)[field].alias(field) for field in df.schema[name].dataType.names]


def expand_struct(df: DataFrame, name: str) -> DataFrame:
    """Replace struct column ``name`` by its fields."""
    others = [F.col(c) for c in df.columns if c != name]
    return df.select(*others, *struct_columns(df, name))


def expand_map(df: DataFrame, name: str, key_name: str) -> DataFrame:
    """One row per map entry: the key as ``key_name``, a struct value as its fields."""
    others = [F.col(c) for c in df.columns if c != name]
    rows = df.select(*others, F.explode(name).alias(key_name, "value"))
    value_type = df.schema[name].dataType.valueType
    if isinstance(value_type, T.StructType):
        return expand_struct(rows, "value")
    return rows


def array_total(items: Column) -> Column:
    """Sum of an array; null when an element is null."""
    return F.aggregate(items, F.lit(0).cast("int"), lambda total, item: total + item)


def array_shift(items: Column, by: int) -> Column:
    """Add ``by`` to every number of an array of arrays."""
    return F.transform(items, lambda inner: F.transform(inner, lambda item: item + by))


def pair_products(pairs: Column, left: str, right: str) -> Column:
    """Product of two fields for every struct of an array."""
    return F.transform(pairs, lambda p: p[left] * p[right])


def any_pair_over(pairs: Column, left: str, right: str, limit: int) -> Column:
    """Whether some struct has two fields that add up to more than ``limit``."""
    return F.exists(pairs, lambda p: p[left] + p[right] > limit)


def items_over(items: Column, limit: int) -> Column:
    """The array elements above ``limit``."""
    return F.filter(items, lambda item: item > limit)


def sensor_rows(df: DataFrame, source: str = "source") -> DataFrame:
    """One row per sensor of a map of structs, nested position included."""
    reading = F.col("value")
    return df.select("dc_id", F.explode(source)).select(
        F.col("dc_id").alias("dcId"), F.col("key").alias("deviceType"),
        reading["ip"].alias("ip"), reading["id"].alias("deviceId"),
        reading["c02_level"].alias("c02_level"), reading["temp"].alias("temp"),
        reading["geo"]["lat"].alias("lat"), reading["geo"]["long"].alias("lon"))


def apply_each(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run DataFrame-to-DataFrame functions one after the other."""
    for step in steps:
        df = df.transform(step)
    return df
