"""Column kinds and type families.

A kind is the outer type of a column: ``LONG`` for a bigint, ``LIST`` for any
array. Everything here works on a schema, so a mistake is reported before a
job starts.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Kind names and the Spark type each one stands for.
KINDS = {
    "BOOLEAN": T.BooleanType,
    "BYTE": T.ByteType,
    "SHORT": T.ShortType,
    "INT": T.IntegerType,
    "LONG": T.LongType,
    "FLOAT": T.FloatType,
    "DOUBLE": T.DoubleType,
    "STRING": T.StringType,
    "LIST": T.ArrayType,
    "MAP": T.MapType,
    "STRUCT": T.StructType,
}

INTEGERS = ("BYTE", "SHORT", "INT", "LONG")
FLOATS = ("FLOAT", "DOUBLE")
COLLECTIONS = ("LIST", "MAP", "STRUCT")
MAP_LIKE = ("MAP", "STRUCT")


class UnsupportedTypeError(TypeError):
    """A column type outside the supported set (decimal, date, timestamp, binary, ...)."""


def kind_of(dtype: T.DataType) -> str:
    """Kind name of a Spark type; raises for types outside the strict set."""
    for kind, spark_type in KINDS.items():
        if isinstance(dtype, spark_type):
            return kind
    raise UnsupportedTypeError(
        f"type {dtype.simpleString()} is not supported; supported kinds: {', '.join(KINDS)}"
    )


def kind_or_type_name(dtype: T.DataType) -> str:
    """Kind name, or Spark's own name in upper case for types outside the strict set."""
    try:
        return kind_of(dtype)
    except UnsupportedTypeError:
        return dtype.simpleString().upper()


def is_integer(dtype: T.DataType) -> bool:
    return kind_or_type_name(dtype) in INTEGERS


def is_floating_point(dtype: T.DataType) -> bool:
    return kind_or_type_name(dtype) in FLOATS


def is_collection(dtype: T.DataType) -> bool:
    return kind_or_type_name(dtype) in COLLECTIONS


def is_map_like(dtype: T.DataType) -> bool:
    return kind_or_type_name(dtype) in MAP_LIKE


def is_primitive(dtype: T.DataType) -> bool:
    return not is_collection(dtype)


def assert_supported_types(schema: T.StructType) -> None:
    """Raise with every offending column if any type is outside the strict set."""
    offending = []
    for field in schema.fields:
        try:
            kind_of(field.dataType)
        except UnsupportedTypeError:
            offending.append(f"{field.name} {field.dataType.simpleString()}")
    if offending:
        raise UnsupportedTypeError("unsupported column types: " + ", ".join(offending))
