"""Rows as printed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.functions.text import printed
from tablegate.spec import quote_name

# Fixed value: default column separator of printed rows.
DEFAULT_SEPARATOR = "\t"


def format_lines(
    df: DataFrame, separator: str = DEFAULT_SEPARATOR, partition_keys: tuple[str, ...] = ()
) -> DataFrame:
    """One ``line`` per row: data columns joined by ``separator``, null as ``null``.

    Partition values are left out.
    """
    values = [
        printed(df[quote_name(f.name)], f.dataType)
        for f in df.schema.fields
        if f.name not in partition_keys
    ]
    return df.select(F.concat_ws(separator, *values).alias("line"))


def debug_text(df: DataFrame) -> DataFrame:
    """One ``text`` per row naming each column's type and value, nulls included."""
    values = [
        F.concat(
            F.lit(f"{f.name}:{f.dataType.simpleString()}="),
            printed(df[quote_name(f.name)], f.dataType),
        )
        for f in df.schema.fields
    ]
    return df.select(F.concat(F.lit("["), F.concat_ws(",", *values), F.lit("]")).alias("text"))
