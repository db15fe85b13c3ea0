"""Source mixing where ids or broadcasts fail."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablegate.llm import mixing, sizes


def test_rows_without_an_id_meet_their_target(spark):
    """They are drawn by their texts, not all by one draw."""
    rows = [(None, f"w{i} a b c", s) for s in ("a", "b", "c") for i in range(3000)]
    mixed = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    taken = mixed.groupBy("source").agg(
        F.sum(F.col("mix.size") * F.col("mix.copies")).alias("taken"), F.first("mix.target").alias("target")
    )
    for r in taken.collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.05)
    again = mixing.mix_sources(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string"))
    assert sorted(map(str, again.select("text", "source", "mix.copies").collect())) == sorted(
        map(str, mixed.select("text", "source", "mix.copies").collect())
    )


def test_large_tables_are_joined_by_salts(spark):
    rows = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 7).alias("k"))
    table = rows.select("k").distinct().withColumn("v", F.coalesce("k", F.lit(-1)) * 10)
    salted = sizes.join_small(rows, table, "k", [F.col("id")], most=2)
    broadcast = sizes.join_small(rows, table, "k", [F.col("id")])
    assert sorted(map(str, salted.select("id", "v").collect())) == sorted(map(str, broadcast.select("id", "v").collect()))
    assert salted.count() == 2000
