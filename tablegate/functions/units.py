"""Byte and bit units as Column expressions."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_WORD_SIZE = 8


def _scale(suffix: str, base_name: str) -> dict[str, float]:
    units = {base_name: 1.0}
    for power, letter in enumerate("KMGTP", start=1):
        units[f"{letter}i{suffix}"] = 1024.0**power
        units[f"{letter}{suffix}"] = 1000.0**power
    return units


BYTE_UNITS = _scale("B", "B")
BIT_UNITS = _scale("bit", "bit")


def _factor(unit: str) -> tuple[float, bool]:
    if unit in BYTE_UNITS:
        return BYTE_UNITS[unit], True
    if unit in BIT_UNITS:
        return BIT_UNITS[unit], False
    raise ValueError(f"unknown unit {unit!r}; known: {', '.join([*BYTE_UNITS, *BIT_UNITS])}")


def saturating_product(value: Column, factor: float) -> Column:
    """``value * factor``, held at the largest finite double instead of infinity."""
    product = value.cast("double") * F.lit(factor)
    limit = sys.float_info.max
    # not-a-number compares greater than any number, so it is let through first
    return (
        F.when(F.isnan(product), product)
        .when(product > limit, F.lit(limit))
        .when(product < -limit, F.lit(-limit))
        .otherwise(product)
    )


def convert_size(
    value: Column | str, from_unit: str, to_unit: str, word_size: int = DEFAULT_WORD_SIZE
) -> Column:
    """``value`` in ``from_unit`` expressed in ``to_unit``.

    Units: ``B KiB MiB GiB TiB PiB KB MB GB TB PB`` and the same with ``bit``.
    Between bytes and bits one byte is ``word_size`` bits.
    """
    column = F.col(value) if isinstance(value, str) else value
    from_factor, from_bytes = _factor(from_unit)
    to_factor, to_bytes = _factor(to_unit)
    base = saturating_product(column, from_factor) if from_factor != 1.0 else column.cast("double")
    if from_bytes and not to_bytes:
        base = saturating_product(base, float(word_size))
    elif to_bytes and not from_bytes:
        base = base / F.lit(float(word_size))
    return base / F.lit(to_factor) if to_factor != 1.0 else base


def to_megabytes(size_in_bytes: Column | str) -> Column:
    """Bytes as decimal megabytes."""
    return convert_size(size_in_bytes, "B", "MB")
