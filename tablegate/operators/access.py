"""Typed access to columns and mapping of rows to named contracts.

Types are checked on the schema, so a wrong type is an error before a job
starts rather than at the first row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.kinds import kind_or_type_name
from tablegate.functions.widening import upgrade_to
from tablegate.spec import quote_name

# Columns of the two edge contracts.
ID_ID_SIM = T.StructType(
    [
        T.StructField("id1", T.LongType()),
        T.StructField("id2", T.LongType()),
        T.StructField("sim", T.DoubleType()),
    ]
)
ID_ID_WEIGHT = T.StructType(
    [
        T.StructField("id1", T.LongType()),
        T.StructField("id2", T.LongType()),
        T.StructField("weight", T.DoubleType()),
    ]
)

# What a primitive getter gives for null, by kind.
NULL_SENTINELS = {
    "BOOLEAN": False,
    "BYTE": -(2**7),
    "SHORT": -(2**15),
    "INT": -(2**31),
    "LONG": -(2**63),
    "FLOAT": 2.0**-149,
    "DOUBLE": float("nan"),
}


NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)


class ColumnTypeError(TypeError):
    """A column whose declared type is not the one asked for."""


def require_type(df: DataFrame, column: str | int, dtype: T.DataType | str) -> Column:
    """The column, if its declared type is exactly ``dtype``.

    ``column`` is a name or a position. For a list the outer kind decides.
    """
    field = _field(df, column)
    wanted = T.DataType.fromDDL(dtype) if isinstance(dtype, str) else dtype
    same_kind = isinstance(wanted, T.ArrayType) and isinstance(field.dataType, T.ArrayType)
    # nullability is no part of a type here
    if field.dataType.simpleString() != wanted.simpleString() and not same_kind:
        raise ColumnTypeError(
            f"column {field.name} is {field.dataType.simpleString()}, not {wanted.simpleString()}"
        )
    return df[quote_name(field.name)]


def get_map(df: DataFrame, column: str | int) -> Column:
    """A map or struct column as a map.

    Struct fields of one type keep it; fields of different types become text:
    plain ones as a cast prints them, nested ones as JSON.
    """
    field = _field(df, column)
    value = df[quote_name(field.name)]
    if isinstance(field.dataType, T.MapType):
        return value
    if not isinstance(field.dataType, T.StructType):
        raise ColumnTypeError(
            f"column {field.name} is {field.dataType.simpleString()}, not a map or struct"
        )
    members = field.dataType.fields
    if len({member.dataType.simpleString() for member in members}) > 1:
        if any(isinstance(member.dataType, NESTED) for member in members):
            return F.from_json(F.to_json(value, {"ignoreNullFields": "false"}), "map<string,string>")
        texts = [part for m in members for part in (F.lit(m.name), value[m.name].cast("string"))]
        return F.when(value.isNotNull(), F.create_map(*texts))
    pairs = [part for m in members for part in (F.lit(m.name), value[m.name])]
    return F.when(value.isNotNull(), F.create_map(*pairs))


def null_sentinels(df: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """Primitive nulls replaced by their kind's fixed value; other columns are untouched."""

    def filled(field: T.StructField) -> Column:
        value = df[quote_name(field.name)]
        kind = kind_or_type_name(field.dataType)
        if kind not in NULL_SENTINELS or (columns and field.name not in columns):
            return value
        sentinel = F.lit(NULL_SENTINELS[kind]).cast(field.dataType)
        return F.coalesce(value, sentinel).alias(field.name)

    return df.select(*(filled(field) for field in df.schema.fields))


def as_rows(
    df: DataFrame, contract: T.StructType | Mapping[str, T.DataType | str | None]
) -> DataFrame:
    """Columns of a row contract, found by name, in contract order.

    Primitive and string fields need exactly the declared type, list fields
    the outer kind. A field of type ``None`` takes any column.
    """
    wanted: Mapping[str, T.DataType | str | None]
    if isinstance(contract, T.StructType):
        wanted = {field.name: field.dataType for field in contract.fields}
    else:
        wanted = contract
    selected = []
    for name, dtype in wanted.items():
        if name not in df.columns:
            raise ColumnTypeError(f"no column for field {name}; columns: {', '.join(df.columns)}")
        selected.append(df[quote_name(name)] if dtype is None else require_type(df, name, dtype))
    return df.select(*selected)


def first_long_long_double(df: DataFrame) -> DataFrame:
    """The first three columns, which must be two longs and a double."""
    return df.select(
        require_type(df, 0, T.LongType()),
        require_type(df, 1, T.LongType()),
        require_type(df, 2, T.DoubleType()),
    )


def data_columns(df: DataFrame, partition_keys: tuple[str, ...]) -> DataFrame:
    """The row without its partition values."""
    return df.select(*(df[quote_name(n)] for n in df.columns if n not in partition_keys))


def rows_from_positions(df: DataFrame, positions: str, schema: T.StructType) -> DataFrame:
    """Typed rows from a map of position to value; absent positions are null.

    Values are widened to the declared type, as on any write.
    """
    field = _field(df, positions)
    if not isinstance(field.dataType, T.MapType):
        raise ColumnTypeError(f"column {positions} is not a map")
    source = df[quote_name(positions)]
    untyped = df.select(
        *(
            F.try_element_at(source, F.lit(i).cast(field.dataType.keyType)).alias(target.name)
            for i, target in enumerate(schema.fields)
        )
    )
    return upgrade_to(untyped, schema)


def _field(df: DataFrame, column: str | int) -> T.StructField:
    fields = df.schema.fields
    if isinstance(column, int):
        if not 0 <= column < len(fields):
            raise ColumnTypeError(f"no column at position {column}; there are {len(fields)}")
        return fields[column]
    for field in fields:
        if field.name == column:
            return field
    raise ColumnTypeError(f"no column {column}; columns: {', '.join(df.columns)}")
