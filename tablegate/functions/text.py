"""Printed text of values and of partition directories."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_WORD = "null"

# Fixed value: directory name of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Fixed value: characters written as %XX in a partition directory name.
PATH_ESCAPED = "[\\x01-\\x1F\"#%'*/:=?\\\\\\x7F{\\[\\]^]"


def printed(value: Column, dtype: T.DataType) -> Column:
    """Text of a value as the tail job prints it; null is the word ``null``.

    Lists look like ``[1, 2]``; maps and structs like ``{a=1, b=2}``.
    """
    if isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda e: printed(e, dtype.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(dtype, T.MapType):
        items = F.transform(
            F.map_entries(value),
            lambda e: F.concat(
                printed(e["key"], dtype.keyType), F.lit("="), printed(e["value"], dtype.valueType)
            ),
        )
        text = F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}"))
    elif isinstance(dtype, T.StructType):
        items = [
            F.concat(F.lit(f"{f.name}="), printed(value[f.name], f.dataType)) for f in dtype.fields
        ]
        joined = F.concat(F.lit("{"), F.concat_ws(", ", *items), F.lit("}"))
        text = F.when(value.isNotNull(), joined)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(NULL_WORD))


def escape_path_value(value: Column) -> Column:
    """Partition value as it appears in a directory name."""
    characters = F.split(value, "")
    escaped = F.transform(
        characters,
        lambda c: F.when(
            c.rlike(PATH_ESCAPED), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))
        ).otherwise(c),
    )
    return F.when(value.rlike(PATH_ESCAPED), F.array_join(escaped, "")).otherwise(value)


def unescape_path_value(text: Column) -> Column:
    """Inverse of :func:`escape_path_value`."""
    # url_decode reads a plus as a blank, which directory names do not mean
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def partition_path(values: Mapping[str, Column]) -> Column:
    """``k1=v1/k2=v2`` for the given keys, in the given (table key) order.

    A null or empty value has the name that stands for null, so a path has as
    many levels as there are keys.
    """
    parts = []
    for key, column in values.items():
        text = F.nullif(column.cast("string"), F.lit(""))
        name = F.coalesce(escape_path_value(text), F.lit(NULL_PARTITION))
        parts.append(F.concat(F.lit(f"{key}="), name))
    return F.concat_ws("/", *parts)
