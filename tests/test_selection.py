"""Names, partition filters, statistics and format groups: one rule each for reads, lists and writes."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.decode import decode
from tablegate.operators.access import get_map
from tablegate.operators.stats import partition_stats, stored_stats
from tablegate.functions.widening import upgrade_to
from tablegate.sinks.tables import write_table
from tablegate.sources.partitions import list_partitions
from tablegate.sources.tables import FormatGroup, read_mixed_formats, read_table
from tablegate.spec import DelimitedFormat, ReadSpec, WriteSpec


@pytest.fixture
def other_database(spark):
    """A current database other than default, with a table of the same name in both."""
    name = f"other_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    for database, rows in (("default", 1), (name, 2)):
        spark.sql(f"CREATE TABLE {database}.same_name (a BIGINT) USING parquet")
        spark.sql(f"INSERT INTO {database}.same_name SELECT id FROM range({rows})")
    spark.catalog.setCurrentDatabase(name)
    yield name
    spark.catalog.setCurrentDatabase("default")
    spark.sql("DROP TABLE default.same_name")
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_a_bare_name_means_default(spark, other_database):
    for splits in (None, 2):
        assert read_table(spark, ReadSpec(table="same_name", num_splits=splits)).count() == 1
        qualified = ReadSpec(table=f"{other_database}.same_name", num_splits=splits)
        assert read_table(spark, qualified).count() == 2
    write_table(spark.range(3).toDF("a"), WriteSpec("same_name"), check=False)
    assert spark.table("default.same_name").count() == 4
    assert spark.table("same_name").count() == 2
    spark.sql("ANALYZE TABLE default.same_name COMPUTE STATISTICS")
    assert stored_stats(spark, "same_name").num_rows == 4


def test_a_view_is_no_table(spark):
    spark.range(1).createOrReplaceTempView("only_a_view")
    with pytest.raises(Exception, match="only_a_view"):
        read_table(spark, ReadSpec(table="only_a_view"))
    spark.catalog.dropTempView("only_a_view")


@pytest.fixture
def by_hour(spark):
    spark.sql("CREATE TABLE by_hour (a BIGINT, hr INT) USING parquet PARTITIONED BY (hr)")
    for hour in (1, 2, 10):
        spark.sql(f"INSERT INTO by_hour PARTITION (hr = {hour}) SELECT id FROM range({hour})")
    spark.sql("ALTER TABLE by_hour ADD PARTITION (hr = 11)")
    yield "by_hour"
    spark.sql("DROP TABLE by_hour")


def test_one_meaning_of_a_filter(spark, by_hour):
    spec = ReadSpec(table=by_hour, partition_filter="hr < '2'")
    rows = read_table(spark, spec)
    assert {r.hr for r in rows.collect()} == {"1", "10"}
    assert {r.hr for r in list_partitions(spark, spec).collect()} == {"1", "10", "11"}
    assert {r.hr for r in partition_stats(spark, spec).collect()} == {"1", "10", "11"}
    [line] = [s for s in rows._jdf.queryExecution().toString().splitlines() if "PartitionFilters: [" in s][-1:]
    assert "PartitionFilters: []" not in line and "hr" in line.split("PartitionFilters:")[1]


def test_partitions_without_rows_are_counted(spark, by_hour, tmp_path):
    found = {r.hr: r for r in partition_stats(spark, ReadSpec(table=by_hour)).collect()}
    assert {hour: r.num_rows for hour, r in found.items()} == {"1": 1, "2": 2, "10": 10, "11": 0}
    assert found["11"].num_files == found["11"].total_size == 0 < found["1"].num_files
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(f"{path}/ds=a")
    spark.range(0).write.parquet(f"{path}/ds=b")
    spec = ReadSpec(path=path, schema=T.DataType.fromDDL("id bigint"), partition_keys=("ds",))
    rows = {r.ds: r for r in partition_stats(spark, spec).collect()}
    assert rows["b"].num_rows == 0 and rows["b"].num_files == 1 and rows["b"].total_size > 0
    assert rows["a"].num_rows == 3 and rows["a"].raw_size == 24


def test_an_unlisted_partition_is_an_error(spark, tmp_path):
    path, schema = str(tmp_path / "t"), T.DataType.fromDDL("id bigint")
    for value in ("a", "b%2Fc", "__HIVE_DEFAULT_PARTITION__"):
        spark.range(1).write.parquet(f"{path}/ds={value}")
    spec = ReadSpec(path=path, schema=schema, partition_keys=("ds",))
    all_of_them = [f"{path}/ds={v}" for v in ("a", "b%2Fc", "__HIVE_DEFAULT_PARTITION__")]
    rows = read_mixed_formats(spark, path, [FormatGroup("parquet", tuple(all_of_them), schema)], spec)
    assert {r.ds for r in rows.collect()} == {"a", "b/c", None}
    with pytest.raises(ValueError, match="no format is given for partition"):
        read_mixed_formats(spark, path, [FormatGroup("parquet", tuple(all_of_them[:2]), schema)], spec)


def test_only_nullability_differs(spark):
    rows = spark.sql("SELECT array(1L) AS a, map('k', 1L) AS m, named_struct('s', 1L) AS s")
    target = T.DataType.fromDDL("a array<bigint>, m map<string,bigint>, s struct<s:bigint>")
    plan = upgrade_to(rows, target)._jdf.queryExecution().analyzed().toString()
    assert "transform" not in plan


def test_mixed_structs_without_json(spark):
    rows = spark.sql("SELECT named_struct('a', 1L, 'b', 'x', 'c', CAST(NULL AS DOUBLE)) AS s UNION ALL SELECT NULL")
    mapped = rows.select(get_map(rows, "s").alias("m"))
    assert "json" not in mapped._jdf.queryExecution().analyzed().toString()
    assert [r.m for r in mapped.collect()] == [{"a": "1", "b": "x", "c": None}, None]


@pytest.mark.parametrize("separator", [",", "-", "e", "1", "]", "^", "\\", "\x02", "é", " "])
@pytest.mark.parametrize("kind", ["bigint", "tinyint", "double", "string"])
def test_lists_decode_item_by_item(spark, separator, kind):
    """The one-cast path gives what decoding every item alone does."""
    fmt = DelimitedFormat(separators=("\t", separator, ":"))
    items = ["1", "-2", "+3", "", " 4", "5 ", "6.5", "7e2", "1e", "300", "99999999999999999999", "\\N", "NaN", "nan", "x", ".", "-", "\x01" + "8"]
    texts = [separator.join(items[i : i + n]) for n in (1, 2, 5) for i in range(len(items))] + ["", None, "\\N"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    dtype = T.ArrayType(T.DataType.fromDDL(kind))
    parts = F.split(F.nullif("t", F.lit("\\N")), "\\Q" + separator + "\\E", -1)
    alone = F.when(F.col("t") == "", F.array().cast(dtype)).otherwise(
        F.transform(parts, lambda e: decode(e, dtype.elementType, fmt))
    )
    both = frame.select("t", decode(F.col("t"), dtype, fmt).alias("a"), alone.alias("b"))
    assert both.where("NOT (a <=> b)").collect() == []
