"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    Written out plainly, an expression used in several places of a
    higher-order function is computed in each of them.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
