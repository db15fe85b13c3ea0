"""Long arrays inside one expression: running values, search, parts of a text, each in about linear time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablegate.functions.bind import bind

BLOCK_BITS = 8
PIECE_BITS = 12
SEARCH_STEPS = 31


def running(values: Column, combine: Callable[[Column, Column], Column], start: int = 0) -> Column:
    """Array of ints whose entry i combines ``start`` and the entries up to i.

    An array that grows entry by entry is copied each time, so it grows in
    blocks only: first over the totals of blocks, then inside each block.
    """
    none = F.array().cast("array<int>")

    def along(items: Column, before: Column) -> Column:
        last = lambda seen: F.coalesce(F.get(seen, F.size(seen) - 1), before)
        return F.aggregate(items, none, lambda seen, v: F.concat(seen, F.array(combine(last(seen), v))))

    def by_block(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(start), combine))
        ends = along(totals, F.lit(start))
        return bind(
            F.concat(F.array(F.lit(start)), ends),
            lambda before: F.flatten(F.transform(blocks, lambda block, i: along(block, F.get(before, i)))),
        )

    def cut(items: Column) -> Column:
        last = F.shiftright(F.greatest(F.size(items) - 1, F.lit(0)), BLOCK_BITS)
        size = 1 << BLOCK_BITS
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * size + 1, F.lit(size)))
        return bind(blocks, by_block)

    return bind(values, cut)


def running_sum(values: Column) -> Column:
    return running(values, lambda a, b: a + b)


def running_max(values: Column) -> Column:
    return running(values, lambda a, b: F.greatest(a, b))


def count_below(ascending: Column, bound: Column) -> Column:
    """How many entries of an ascending array are below the bound, by halving."""
    start = F.struct(F.lit(0).alias("low"), F.size(ascending).alias("high"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["low"] + at["high"], 1)
        above = F.get(ascending, middle) < bound
        return F.when(
            at["low"] < at["high"],
            F.struct(
                F.when(above, middle + 1).otherwise(at["low"]).alias("low"),
                F.when(above, at["high"]).otherwise(middle).alias("high"),
            ),
        ).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(SEARCH_STEPS)), start, halve, lambda at: at["low"])


def pieces_of(text: Column) -> Column:
    """A text in pieces of equal length, so that parts are found without a walk from its start."""
    size = 1 << PIECE_BITS
    count = F.shiftright(F.length(text), PIECE_BITS)
    return F.transform(F.sequence(F.lit(0), count), lambda k: F.substring(text, k * size + 1, F.lit(size)))


def part_of(pieces: Column, start: Column, end: Column) -> Column:
    """Characters from ``start`` up to but not with ``end`` of a text in pieces."""
    mask = (1 << PIECE_BITS) - 1
    first, last = F.shiftright(start, PIECE_BITS), F.shiftright(end, PIECE_BITS)
    here = start.bitwiseAND(mask) + 1
    across = F.concat(
        F.substring(F.get(pieces, first), here, F.lit(mask + 1)),
        F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        F.substring(F.get(pieces, last), F.lit(1), end.bitwiseAND(mask)),
    )
    return F.when(first == last, F.substring(F.get(pieces, first), here, end - start)).otherwise(across)
