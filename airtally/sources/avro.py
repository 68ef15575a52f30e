"""Avro values, where Spark's Avro package is on the class path."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro.functions import from_avro, to_avro

from airtally.sources.topics import frame_value, split_framed

# Avro names of the simple types.
NAMES = {"integer": "int", "long": "long", "float": "float", "double": "double",
         "string": "string", "boolean": "boolean", "binary": "bytes"}


def avro_available(spark: SparkSession) -> bool:
    """Whether the session can load Spark's Avro functions."""
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:
        return False
    return True


def _avro_type(kind: T.DataType, name: str):
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return {"type": "long", "logicalType": "timestamp-micros"}
    if isinstance(kind, T.DateType):
        return {"type": "int", "logicalType": "date"}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": ["null", _avro_type(kind.elementType, name)]}
    if isinstance(kind, T.MapType):
        return {"type": "map", "values": ["null", _avro_type(kind.valueType, name)]}
    if isinstance(kind, T.StructType):
        return _record(kind, name)
    return NAMES[kind.typeName()]


def _record(schema: T.StructType, name: str) -> dict:
    return {"type": "record", "name": name, "fields": [
        {"name": f.name, "type": ["null", _avro_type(f.dataType, f"{name}_{f.name}")],
         "default": None} for f in schema.fields]}


def avro_schema(schema: T.StructType, name: str = "topLevelRecord") -> str:
    """Avro schema text of a DataFrame schema, every field nullable."""
    return json.dumps(_record(schema, name))


def schema_file(spark: SparkSession, path: str) -> str:
    """Schema text of an ``.avsc`` file."""
    return spark.read.text(path, wholetext=True).first()[0]


def subject_of(topic: str) -> str:
    """The name a topic's value schema is registered under."""
    return f"{topic}-value"


def avro_encode(df: DataFrame, schema_id: int | None = None) -> DataFrame:
    """All columns as one Avro ``value``, framed when a schema id is given."""
    value = to_avro(F.struct("*"), avro_schema(df.schema))
    if schema_id is not None:
        value = frame_value(F.lit(schema_id), value)
    return df.select(value.alias("value"))


def avro_decode(messages: DataFrame, schema: str, framed: bool = False) -> DataFrame:
    """Avro values to plain columns by a reader schema."""
    column, rows = ("payload", split_framed(messages)) if framed else ("value", messages)
    return rows.select(from_avro(F.col(column), schema).alias("data")).select("data.*")
