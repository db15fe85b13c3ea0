"""Decode rules for delimited text, as Column expressions.

Every rule is a built-in expression, so a text scan stays in the JVM. A
malformed value decodes to null; :func:`undecodable` tells it apart from a
value that was null in the file.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.bind import bind
from tablegate.functions.kinds import UnsupportedTypeError, is_floating_point, is_integer, kind_of
from tablegate.functions.widening import first_entry_map
from tablegate.spec import DelimitedFormat

# Accepted spellings, as patterns over the whole text.
TRUE_PATTERN = "^(?i:true)\\z"
FALSE_PATTERN = "^(?i:false)\\z"
OTHER_WORD_PATTERN = "^\\s*[+-]?(?!NaN|Infinity)[a-zA-Z]"

PARSE_MODES = ("lazy", "bytes")


def split_pattern(separator: str) -> str:
    """Pattern for ``F.split`` that takes one separator literally.

    One plain character, or a backslash and one character, is split without
    a regular expression by the JVM.
    """
    return "\\" + separator if separator in ".$|()[{^?*+\\" else separator


def split_text(text: Column, separator: str, limit: int = -1) -> Column:
    return F.split(text, split_pattern(separator), limit)


def decode(text: Column, dtype: T.DataType, fmt: DelimitedFormat, level: int = 1) -> Column:
    """Value of one field text. ``level`` is the separator depth for collections."""
    present = F.nullif(text, F.lit(fmt.null_text))
    if isinstance(dtype, T.StringType):
        return present
    if isinstance(dtype, T.BooleanType):
        return decode_boolean(text)
    if is_integer(dtype):
        return decode_integer(text, dtype)
    if is_floating_point(dtype):
        return decode_float(text, dtype)
    if isinstance(dtype, T.ArrayType):
        return _decode_list(present, dtype, fmt, level)
    if isinstance(dtype, T.MapType):
        return _decode_map(present, dtype, fmt, level)
    if isinstance(dtype, T.StructType):
        return _decode_struct(present, dtype, fmt, level)
    raise UnsupportedTypeError(f"no text form for {dtype.simpleString()}")


def decode_boolean(text: Column) -> Column:
    """``true`` / ``false`` in any letter case and nothing else, blanks included."""
    return (
        F.when(text == "true", F.lit(True))
        .when(text == "false", F.lit(False))
        .when(text.rlike(TRUE_PATTERN), F.lit(True))
        .when(text.rlike(FALSE_PATTERN), F.lit(False))
    )


def decode_integer(text: Column, dtype: T.DataType) -> Column:
    """Optional sign and digits. Anything else, or a value out of range, is null.

    ``try_cast`` settles everything but blanks and control characters around
    the number, which it trims. Comparing the first and the last character
    rules those out at a fraction of the cost of a pattern.
    """
    starts_bare = (text >= "+") & (text < ":")
    ends_bare = (F.substring(text, -1, 1) >= "0") & ~text.endswith("\x7f")
    return F.when(starts_bare & ends_bare, text.try_cast(dtype))


def decode_float(text: Column, dtype: T.DataType) -> Column:
    """Number text with exponent forms, ``NaN`` and ``Infinity``.

    ``try_cast`` also takes ``nan`` and ``inf`` in any letter case. Text that
    starts like a number cannot be such a word; only the rest is looked at.
    """
    numeric = ((text >= ".") & (text < ":")) | ((text >= "-.") & (text < "-:"))
    return F.when(numeric | ~text.rlike(OTHER_WORD_PATTERN), text.try_cast(dtype))


def _decode_list(present: Column, dtype: T.ArrayType, fmt: DelimitedFormat, level: int) -> Column:
    items = split_text(present, fmt.separator(level))
    decoded = F.transform(items, lambda e: decode(e, dtype.elementType, fmt, level + 1))
    value = F.when(present == "", F.array().cast(dtype))
    plain = _plain_list(present, dtype.elementType, fmt, level)
    if plain is not None:
        value = value.when(plain, items.try_cast(dtype))
    return value.otherwise(decoded)


def _plain_list(present: Column, element: T.DataType, fmt: DelimitedFormat, level: int) -> Column | None:
    """True where one cast of all items gives what decoding each of them does; None if no such test exists.

    Numbers: the field has signs, digits and separators only (for floats also
    dots and exponents), so no blank, control character or word can reach the
    cast. Strings: no item can be the null text.
    """
    separator = "\\" + fmt.separator(level) if fmt.separator(level).isascii() and not fmt.separator(level).isalnum() else fmt.separator(level)
    if is_integer(element):
        return present.rlike(rf"^[0-9+\-{separator}]*+\z")
    if is_floating_point(element):
        return present.rlike(rf"^[0-9+\-.eE{separator}]*+\z")
    if isinstance(element, T.StringType) and fmt.null_text:
        return ~present.contains(fmt.null_text)
    return None


def _decode_map(present: Column, dtype: T.MapType, fmt: DelimitedFormat, level: int) -> Column:
    key_separator = fmt.separator(level + 1)

    def entry(parts: Column) -> Column:
        return F.struct(
            decode(F.get(parts, F.lit(0)), dtype.keyType, fmt, level + 2).alias("key"),
            decode(F.get(parts, F.lit(1)), dtype.valueType, fmt, level + 2).alias("value"),
        )

    items = split_text(present, fmt.separator(level))
    # the key ends at the first key separator; without one there is no value
    pairs = F.transform(items, lambda item: split_text(item, key_separator, 2))
    entries = F.transform(pairs, entry)
    empty = F.create_map().cast(dtype)
    return F.when(present == "", empty).otherwise(first_entry_map(entries))


def _decode_struct(
    present: Column, dtype: T.StructType, fmt: DelimitedFormat, level: int
) -> Column:
    def fields(parts: Column) -> Column:
        return F.struct(
            *(
                decode(F.get(parts, F.lit(i)), field.dataType, fmt, level + 1).alias(field.name)
                for i, field in enumerate(dtype.fields)
            )
        )

    parts = split_text(present, fmt.separator(level))
    return F.when(present.isNotNull(), bind(parts, fields))


def undecodable(text: Column, dtype: T.DataType, fmt: DelimitedFormat, level: int = 1) -> Column:
    """True where the text holds a value, in the file's terms, that decodes to null."""
    kind = kind_of(dtype)
    present = F.nullif(text, F.lit(fmt.null_text))
    if kind == "STRING":
        return F.lit(False)
    if kind == "LIST":
        items = split_text(present, fmt.separator(level))
        found = F.exists(items, lambda e: undecodable(e, dtype.elementType, fmt, level + 1))
        return (present != "") & F.coalesce(found, F.lit(False))
    if kind == "MAP":
        key_separator = fmt.separator(level + 1)

        def bad_entry(parts: Column) -> Column:
            return undecodable(F.get(parts, F.lit(0)), dtype.keyType, fmt, level + 2) | (
                undecodable(F.get(parts, F.lit(1)), dtype.valueType, fmt, level + 2)
            )

        items = split_text(present, fmt.separator(level))
        pairs = F.transform(items, lambda item: split_text(item, key_separator, 2))
        return (present != "") & F.coalesce(F.exists(pairs, bad_entry), F.lit(False))
    if kind == "STRUCT":

        def bad_field(parts: Column) -> Column:
            bad = F.lit(False)
            for i, field in enumerate(dtype.fields):
                bad = bad | undecodable(F.get(parts, F.lit(i)), field.dataType, fmt, level + 1)
            return bad

        return bind(split_text(present, fmt.separator(level)), bad_field)
    has_text = present.isNotNull() & (present != "")
    return F.coalesce(has_text, F.lit(False)) & decode(text, dtype, fmt, level).isNull()


def checked(
    text: Column, dtype: T.DataType, fmt: DelimitedFormat, name: str, on_bad: str
) -> Column:
    """Decoded value; with ``on_bad="fail"`` a malformed value stops the job."""
    value = decode(text, dtype, fmt)
    if on_bad == "null" or isinstance(dtype, T.StringType):
        return value
    if on_bad != "fail":
        raise ValueError(f"on_bad is 'null' or 'fail', not {on_bad!r}")
    message = F.concat(F.lit(f"column {name}: cannot decode "), text)
    return F.when(
        undecodable(text, dtype, fmt), F.raise_error(message).cast(dtype)
    ).otherwise(value)
