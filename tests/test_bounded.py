"""Output files bounded by bytes: nothing lost, no file above the bound, few files."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from tablegate import WriteSpec, bounded_by_bytes, row_bytes, write_table

NUMBER = itertools.count()
MOST = 10_000


@pytest.fixture
def mixed(spark):
    """Narrow rows, wide ones, one above the bound, nulls and equal rows, in columns of the operator's own names."""
    widths = [0, 3, 3, None, 40, 700, MOST // 8, MOST // 2, 20, 3] * 60 + [3 * MOST]
    rows = [(i % 7, None if n is None else "x" * n, n) for i, n in enumerate(widths)]
    return spark.createDataFrame(rows, "bytes int, file string, `a.b` long").repartition(3)


def tasks(frame):
    """Bytes and rows of each task."""
    sized = frame.withColumn("n", row_bytes(frame.schema))
    return [
        (r["total"], r["rows"])
        for r in sized.groupBy(F.spark_partition_id()).agg(F.sum("n").alias("total"), F.count("*").alias("rows")).collect()
    ]


def test_no_task_passes_the_bound(mixed):
    dealt = bounded_by_bytes(mixed, MOST)
    assert dealt.columns == mixed.columns
    assert sorted(dealt.collect(), key=str) == sorted(mixed.collect(), key=str)
    found = tasks(dealt)
    assert all(total <= MOST or rows == 1 for total, rows in found)
    assert sum(total > MOST for total, _ in found) == 1


def test_narrow_rows_fill_their_files(spark):
    narrow = spark.range(20_000, numPartitions=2).select("id", F.lit("abc").alias("t"))
    found = tasks(bounded_by_bytes(narrow, MOST))
    assert all(total <= MOST for total, _ in found)
    assert len(found) <= 20_000 * 15 / (MOST * 7 / 8) + 2


def test_row_bytes(spark):
    row = spark.range(1).selectExpr(
        "1 AS i", "CAST(NULL AS bigint) AS l", "'\u00e4b' AS s", "CAST(NULL AS string) AS n", "true AS b",
        "array(1, 2) AS a", "CAST(1 AS decimal(5, 2)) AS d", "current_timestamp() AS ts",
    )
    assert row.select(row_bytes(row.schema)).first()[0] == 4 + 8 + 7 + 4 + 1 + (4 + len('{"a":[1,2]}')) + 16 + 8


def test_empty_and_wrong_bounds(spark, mixed):
    assert bounded_by_bytes(mixed.where("false"), MOST).collect() == []
    with pytest.raises(ValueError, match="at least one byte"):
        bounded_by_bytes(mixed, 0)
    with pytest.raises(ValueError, match="at most one"):
        WriteSpec("t", num_files=2, max_bytes_per_file=5)


def test_files_of_a_table_and_of_a_partition(spark, mixed):
    rows = mixed.withColumnRenamed("a.b", "width").where(f"coalesce(width, 0) <= {MOST}")
    for spec in ({}, {"ds": "x"}):
        name = f"default.bounded{next(NUMBER)}"
        key = "PARTITIONED BY (ds)" if spec else ""
        columns = "bytes INT, file STRING, width BIGINT" + (", ds STRING" if spec else "")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING json {key}")
        write_table(rows, WriteSpec(name, spec, max_bytes_per_file=MOST))
        held = spark.table(name)
        per_file = held.groupBy("_metadata.file_path").agg(
            F.sum(F.coalesce(F.length("file"), F.lit(0)) + 16).alias("total"), F.count("*").alias("n")
        )
        assert held.count() == rows.count()
        assert per_file.agg(F.max("total")).first()[0] <= MOST
        assert per_file.count() > 1
