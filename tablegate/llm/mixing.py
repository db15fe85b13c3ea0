"""Mixing sources to target weights, in DataFrame operations only.

Tokens are added up per source, targets set by weight and capped, repetition
rates derived, and each document is emitted floor(rate) times plus one
hash-seeded Bernoulli copy with probability equal to the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.sizes import join_small
from tablegate.llm.words import word_count

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``, ``rate``.

    Sources in code-point order, null last, weigh ``weights`` in turn and
    share the total size. A target stops at ``most`` times its source's size
    and the excess is reshared by weight: targets are min(cap, weight * level)
    with one level for all. In order of cap / weight the capped sources come
    first, so running sums give the level without iterating. All sums are
    exact integers; the windows run over one row per source, after the sizes
    are aggregated.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (turn % len(weights) + 1).cast("int"))
    caps = by_source.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ordered = caps.select(
        "*",
        F.sum("source_size").over(whole).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("capped"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
    )
    full = (F.col("cap") / F.col("weight")) * F.col("open") + F.col("capped") <= F.col("total")
    filled = ordered.withColumn("full", full)
    left = filled.select(
        "*",
        (F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))).alias("rest"),
        F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole).alias("shares"),
    )
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        (F.col("weight") * F.col("rest")).cast("double") / F.col("shares").cast("double")
    )
    return left.select("source", "source_size", target.alias("target")).withColumn(
        "rate",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)),
    )


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def mix_sources(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: int = 4,
    name: str = "mix",
) -> DataFrame:
    """Each document with ``mix`` (or another name): its size, source_size, target, rate and copies.

    Two scans of the documents: one adds up sizes per source, one decides.
    A null text has size 0, null is a source of its own, rows without an id
    are drawn by their texts, rows repeated under one id get the same number
    of copies, and an empty table gives no rows. A column of that name is
    replaced. The draw depends on id (or text) and seed, so reruns agree.
    """
    sizes = docs.select(F.col(source_column).alias("source"), word_count(F.col(text_column)).alias("size"))
    rates = source_targets(sizes, weights, most)
    table = rates.select(F.col("source").alias("__source"), F.struct("source_size", "target", "rate").alias("__rate"))
    keyed = docs.drop(name).withColumn("__source", F.col(source_column))
    joined = join_small(keyed, table, "__source", [F.col(id_column), F.col(text_column)])
    rate = F.col("__rate.rate")
    by_text = F.concat(F.lit("text "), F.sha2(F.col(text_column).cast("binary"), 256))
    draw = uniform(F.coalesce(F.col(id_column).cast("string"), by_text), seed) < rate - F.floor(rate)
    mix = F.struct(
        word_count(F.col(text_column)).alias("size"),
        F.col("__rate.source_size").alias("source_size"),
        F.col("__rate.target").alias("target"),
        rate.alias("rate"),
        (F.floor(rate) + draw.cast("long")).alias("copies"),
    )
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns if c != name), mix.alias(name))


def emit_copies(mixed: DataFrame, name: str = "mix") -> DataFrame:
    """Every document as many times as the mix takes it, without the ``mix`` column."""
    times = F.col(name)["copies"]
    copies = F.sequence(F.lit(1).cast("long"), times)
    taken = mixed.where(times > 0).withColumn("__copy", F.explode(copies))
    return taken.drop("__copy", name)
