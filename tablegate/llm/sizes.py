"""Joins against small tables whose size is checked first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 50_000
SALTS = 32


def join_small(
    rows: DataFrame, table: DataFrame, key: str, salt: list[Column], most: int = BROADCAST_ROWS
) -> DataFrame:
    """Inner join on a null-safe key; ``table`` holds each key once.

    Up to ``most`` table rows are broadcast. A larger table is joined by a
    shuffle in which each key's rows are salted over ``SALTS`` tasks, so that
    a key with a third of all rows does not meet in one of them. The salt is a
    hash of the ``salt`` columns, so a task that is repeated after a lost
    executor deals its rows as it did before.
    """
    table = table.withColumnRenamed(key, "__key")
    if table.count() <= most:
        return rows.join(F.broadcast(table), rows[key].eqNullSafe(table["__key"])).drop("__key")
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*salt), F.lit(SALTS)).cast("int"))
    copies = table.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = salted[key].eqNullSafe(copies["__key"]) & (salted["__salt"] == copies["__copy"])
    return salted.join(copies, same).drop("__key", "__salt", "__copy")
