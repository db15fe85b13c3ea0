"""Widening on write: which column may go into which, and the cast that does it.

The rule is decided on the two schemas. Spark's own store-assignment policies
do not fit: ANSI lets bigint into int and checks at run time, STRICT lets any
primitive into string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.bind import bind
from tablegate.functions.kinds import kind_or_type_name
from tablegate.spec import quote_name

# Kinds a column of each kind accepts on write.
ACCEPTED_KINDS = {
    "BOOLEAN": {"BOOLEAN"},
    "BYTE": {"BYTE"},
    "SHORT": {"BYTE", "SHORT"},
    "INT": {"BYTE", "SHORT", "INT"},
    "LONG": {"BYTE", "SHORT", "INT", "LONG"},
    "FLOAT": {"BYTE", "SHORT", "INT", "LONG", "FLOAT"},
    "DOUBLE": {"BYTE", "SHORT", "INT", "LONG", "FLOAT", "DOUBLE"},
    "STRING": {"STRING"},
    "LIST": {"LIST"},
    "MAP": {"MAP"},
    "STRUCT": {"STRUCT", "MAP"},
}


class WideningError(TypeError):
    """A value type that would have to be narrowed or changed in kind."""


def can_widen(source: T.DataType, target: T.DataType) -> bool:
    """True if every value of ``source`` may be stored in a column of ``target``."""
    if isinstance(source, T.NullType) or source == target:
        return True
    source_kind, target_kind = kind_or_type_name(source), kind_or_type_name(target)
    if target_kind == "DOUBLE" and isinstance(source, T.DecimalType):
        return True
    if source_kind not in ACCEPTED_KINDS.get(target_kind, ()):
        return False
    if target_kind == "LIST":
        return can_widen(source.elementType, target.elementType)
    if target_kind == "MAP":
        return can_widen(source.keyType, target.keyType) and can_widen(
            source.valueType, target.valueType
        )
    if target_kind == "STRUCT" and source_kind == "MAP":
        return isinstance(source.keyType, T.StringType) and all(
            can_widen(source.valueType, field.dataType) for field in target.fields
        )
    if target_kind == "STRUCT":
        wanted = {field.name: field.dataType for field in target.fields}
        return all(
            field.name in wanted and can_widen(field.dataType, wanted[field.name])
            for field in source.fields
        )
    return True


def widen(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast ``value`` upward to ``target``; null stays null."""
    if not can_widen(source, target):
        raise WideningError(
            f"cannot store {source.simpleString()} in a {target.simpleString()} column"
        )
    # nullability is no part of a type here: a collection of the same types passes as it is
    if source.simpleString() == target.simpleString():
        return value
    if isinstance(target, T.StructType) and isinstance(source, T.MapType):
        fields = [
            widen(
                F.try_element_at(value, F.lit(field.name)), source.valueType, field.dataType
            ).alias(field.name)
            for field in target.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        have = {field.name: field.dataType for field in source.fields}
        fields = [
            (
                widen(value[field.name], have[field.name], field.dataType)
                if field.name in have
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in target.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType):
        return F.transform(value, lambda e: widen(e, source.elementType, target.elementType))
    if isinstance(target, T.MapType):
        if source.keyType.simpleString() != target.keyType.simpleString():
            # two bigint keys may meet in one float key: the first one stays
            return _widen_map_with_keys(value, source, target)
        return F.transform_values(
            value, lambda _, v: widen(v, source.valueType, target.valueType)
        )
    return value.cast(target)


def _widen_map_with_keys(value: Column, source: T.MapType, target: T.MapType) -> Column:
    entries = F.transform(
        F.map_entries(value),
        lambda e: F.struct(
            widen(e["key"], source.keyType, target.keyType).alias("key"),
            widen(e["value"], source.valueType, target.valueType).alias("value"),
        ),
    )
    return first_entry_map(entries)


def first_entry_map(entries: Column) -> Column:
    """Map from an array of ``{key, value}``; null keys go, the first of equal keys stays.

    ``map_from_entries`` alone fails on a repeated key. Arrays without a
    repeat, the usual case, take the direct branch.
    """

    def build(keyed: Column, keys: Column) -> Column:
        first_only = F.filter(
            keyed, lambda e, i: F.array_position(keys, e["key"]) == (i + 1).cast("bigint")
        )
        return F.when(
            F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_entries(keyed)
        ).otherwise(F.map_from_entries(first_only))

    return bind(
        F.filter(entries, lambda e: e["key"].isNotNull()),
        lambda keyed: bind(keyed["key"], lambda keys: build(keyed, keys)),
    )


def upgrade_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` as rows of ``schema``: columns matched by name, widened, in schema order.

    A column ``df`` does not have is null, as in a fresh row. A column the
    schema does not have is an error, and so is a narrowing; both are found
    on the schemas, before any task runs.
    """
    have = {field.name: field.dataType for field in df.schema.fields}
    unknown = [name for name in have if name not in schema.names]
    if unknown:
        raise WideningError(f"no such column in the target: {', '.join(unknown)}")
    refused = [
        f"{field.name}: {have[field.name].simpleString()} into {field.dataType.simpleString()}"
        for field in schema.fields
        if field.name in have and not can_widen(have[field.name], field.dataType)
    ]
    if refused:
        raise WideningError("cannot widen " + "; ".join(refused))
    return df.select(
        *(
            (
                widen(df[quote_name(field.name)], have[field.name], field.dataType)
                if field.name in have
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in schema.fields
        )
    )


def set_exact(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Strict form of :func:`upgrade_to`: the types must already be the declared ones."""
    wanted = {field.name: field.dataType for field in schema.fields}
    wrong = [
        f"{field.name}: {field.dataType.simpleString()}, declared "
        f"{wanted[field.name].simpleString()}"
        for field in df.schema.fields
        if field.name in wanted and _outer_or_exact(field.dataType) != _outer_or_exact(wanted[field.name])
    ]
    if wrong:
        raise WideningError("column types differ: " + "; ".join(wrong))
    return upgrade_to(df, schema)


def _outer_or_exact(dtype: T.DataType) -> str:
    kind = kind_or_type_name(dtype)
    return "MAP_LIKE" if kind in ("MAP", "STRUCT") else kind
