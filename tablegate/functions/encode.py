"""Delimited text of a value: the inverse of the decode rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.bind import bind
from tablegate.functions.kinds import UnsupportedTypeError, is_primitive, kind_of
from tablegate.spec import DelimitedFormat, quote_name


def encode(
    value: Column, dtype: T.DataType, fmt: DelimitedFormat, level: int = 1, guard: bool = True
) -> Column:
    """Field text of ``value``; null becomes the null text.

    Strings holding a separator in use, or a line break, would come back as
    other values. So would a list whose only item has no text, and a
    collection whose whole text is the null text. With ``guard`` they stop
    the job instead.
    """
    kind = kind_of(dtype)
    null_text = F.lit(fmt.null_text)
    if kind == "STRING":
        text = _guarded(value, fmt, level) if guard else value
    elif is_primitive(dtype):
        text = value.cast("string")
    elif kind == "LIST" and is_primitive(dtype.elementType):
        items = _guarded_items(value, fmt, level) if guard and _is_text(dtype) else value
        text = F.array_join(items.cast("array<string>"), fmt.separator(level), fmt.null_text)
    elif kind == "LIST":
        text = F.array_join(
            F.transform(value, lambda e: encode(e, dtype.elementType, fmt, level + 1, guard)),
            fmt.separator(level),
        )
    elif kind == "MAP":
        key_separator = fmt.separator(level + 1)
        text = F.array_join(
            F.transform(
                F.map_entries(value),
                lambda e: F.concat(
                    encode(e["key"], dtype.keyType, fmt, level + 2, guard),
                    F.lit(key_separator),
                    encode(e["value"], dtype.valueType, fmt, level + 2, guard),
                ),
            ),
            fmt.separator(level),
        )
    elif kind == "STRUCT":
        joined = F.concat_ws(
            fmt.separator(level),
            *(
                encode(value[field.name], field.dataType, fmt, level + 1, guard)
                for field in dtype.fields
            ),
        )
        text = F.when(value.isNotNull(), joined)
    else:
        raise UnsupportedTypeError(f"no text form for {dtype.simpleString()}")
    if guard and kind in ("LIST", "MAP", "STRUCT"):
        text = bind(text, lambda t: _guarded_whole(value, t, kind, fmt))
    return F.coalesce(text, null_text)


def _guarded_whole(value: Column, text: Column, kind: str, fmt: DelimitedFormat) -> Column:
    """Refuse the collections whose text stands for another value: null, or a list without items."""
    unsafe = text == fmt.null_text
    if kind == "LIST":
        unsafe = unsafe | ((F.size(value) > 0) & (text == ""))
    message = F.concat(F.lit(f"a {kind.lower()} would read back as another value; its text is: "), text)
    return F.when(unsafe, F.raise_error(message).cast("string")).otherwise(text)


def _is_text(dtype: T.ArrayType) -> bool:
    return isinstance(dtype.elementType, T.StringType)


def _guarded(value: Column, fmt: DelimitedFormat, level: int) -> Column:
    return _refuse(value, _holds_separator(value, fmt, level) | (value == fmt.null_text), value)


def _guarded_items(items: Column, fmt: DelimitedFormat, level: int) -> Column:
    joined = F.array_join(items, "")
    unsafe = _holds_separator(joined, fmt, level + 1) | F.array_contains(items, fmt.null_text)
    return _refuse(items, unsafe, joined)


def _holds_separator(text: Column, fmt: DelimitedFormat, level: int) -> Column:
    found = F.lit(False)
    for character in (*fmt.separators[:level], "\r", "\n"):
        found = found | text.contains(character)
    return found


def _refuse(value: Column, unsafe: Column, shown: Column) -> Column:
    message = F.concat(F.lit("text holds a separator, a line break or the null text: "), shown)
    return F.when(unsafe, F.raise_error(message)).otherwise(value)


def encode_line(schema: T.StructType, fmt: DelimitedFormat, guard: bool = True) -> Column:
    """Whole line of a row: its fields joined by the outermost separator."""
    return F.concat_ws(
        fmt.separator(0),
        *(
            encode(F.col(quote_name(f.name)), f.dataType, fmt, 1, guard)
            for f in schema.fields
        ),
    )
