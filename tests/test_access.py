"""Typed access, row contracts, printed lines."""

from __future__ import annotations

import math

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate import (
    ID_ID_SIM, ID_ID_WEIGHT, ReadSpec, as_rows, data_columns, first_long_long_double, format_lines, get_map,
    limit_rows, null_sentinels, read_table, require_type, rows_from_positions,
)
from tablegate.functions.widening import WideningError
from tablegate.operators.access import ColumnTypeError
from tablegate.operators.lines import debug_text

parse = T.DataType.fromDDL
ALL = (
    "t1 tinyint, s1 smallint, i1 int, l1 bigint, b1 boolean, f1 float, d1 double, str1 string, "
    "li1 array<bigint>, m1 map<string,float>, st1 struct<a:int,b:string>"
)


@pytest.fixture(scope="module")
def rows(spark):
    values = (1, 2, 3, 4, True, 5.5, 6.5, "foo", [1, 2, 3], {"foo": 1.5}, (7, "x"))
    return spark.createDataFrame([values, (None,) * 11], ALL)


def test_only_the_declared_type_is_given(rows):
    for asked in parse(ALL).fields:
        for position, field in enumerate(parse(ALL).fields):
            if field.name == asked.name:
                assert rows.select(require_type(rows, position, asked.dataType)).count() == 2
                assert rows.select(require_type(rows, field.name, asked.dataType)).count() == 2
            else:
                with pytest.raises(ColumnTypeError, match=field.name):
                    require_type(rows, position, asked.dataType)
    with pytest.raises(ColumnTypeError, match="position 11"):
        require_type(rows, 11, "int")
    with pytest.raises(ColumnTypeError, match="no column nope"):
        require_type(rows, "nope", "int")
    require_type(rows, "li1", "array<int>")


def test_maps(spark, rows):
    assert rows.select(get_map(rows, "m1").alias("m")).first().m == {"foo": 1.5}
    mixed = rows.select(get_map(rows, "st1").alias("m")).collect()
    assert mixed[0].m == {"a": "7", "b": "x"} and mixed[1].m is None
    same = spark.sql("SELECT named_struct('a', 1, 'b', cast(null as int)) AS s")
    assert same.select(get_map(same, "s").alias("m")).first().m == {"a": 1, "b": None}
    nulls = spark.sql("SELECT named_struct('a', 1, 'b', cast(null as string)) AS s")
    assert nulls.select(get_map(nulls, "s").alias("m")).first().m == {"a": "1", "b": None}
    with pytest.raises(ColumnTypeError, match="not a map or struct"):
        get_map(rows, "i1")


def test_null_sentinels(rows):
    row = null_sentinels(rows).where("str1 IS NULL").first()
    assert tuple(row[:6]) == (-128, -32768, -(2**31), -(2**63), False, 2.0**-149)
    assert math.isnan(row.d1)
    assert (row.str1, row.li1, row.m1, row.st1) == (None, None, None, None)
    one = null_sentinels(rows, ("i1",)).where("str1 IS NULL").first()
    assert (one.i1, one.l1) == (-(2**31), None)


def test_row_class(spark):
    lines = [(False, 1, 2, 3, 4, 1.5, 2.5), (True, 2, 3, 4, 5, 2.5, 3.5)]
    schema = "bo1 boolean, by1 tinyint, s1 smallint, i1 int, l1 bigint, f1 float, d1 double"
    frame = spark.createDataFrame(lines, schema)
    contract = T.StructType(list(reversed(parse(schema).fields)))
    assert sorted(map(tuple, as_rows(frame, contract).collect())) == sorted(
        tuple(reversed(line)) for line in lines
    )
    with pytest.raises(ColumnTypeError, match="l1 is bigint, not int"):
        as_rows(frame, parse("l1 int"))
    with pytest.raises(ColumnTypeError, match="no column for field x"):
        as_rows(frame, parse("x int"))
    assert as_rows(frame, {"l1": None, "d1": "double"}).columns == ["l1", "d1"]


def test_edge_contracts(spark):
    edges = spark.createDataFrame([(0.5, 2, 1)], "sim double, id2 bigint, id1 bigint")
    assert tuple(as_rows(edges, ID_ID_SIM).first()) == (1, 2, 0.5)
    assert tuple(as_rows(edges.withColumnRenamed("sim", "weight"), ID_ID_WEIGHT).first()) == (1, 2, 0.5)
    assert first_long_long_double(edges.select("id1", "id2", "sim", F.lit(1))).columns == [
        "id1", "id2", "sim",
    ]
    with pytest.raises(ColumnTypeError, match="sim is double"):
        first_long_long_double(edges)


def test_rows_from_positions(spark):
    frame = spark.createDataFrame(
        [({0: 23, 1: 34, 2: 45},), ({2: 33},), ({},), (None,)], "m map<int,bigint>"
    )
    schema = parse("i1 bigint, i2 double, i3 bigint")
    assert [tuple(r) for r in rows_from_positions(frame, "m", schema).collect()] == [
        (23, 34.0, 45), (None, None, 33), (None, None, None), (None, None, None),
    ]
    with pytest.raises(WideningError):
        rows_from_positions(frame, "m", parse("i1 int"))


def test_lines(spark, rows):
    full, empty = (r.line for r in format_lines(rows, "|").collect())
    assert full == "1|2|3|4|true|5.5|6.5|foo|[1, 2, 3]|{foo=1.5}|{a=7, b=x}"
    assert empty == "|".join(["null"] * 11)
    keyed = spark.createDataFrame([(1, "d")], "a int, ds string")
    assert format_lines(keyed, partition_keys=("ds",)).first().line == "1"
    assert data_columns(keyed, ("ds",)).columns == ["a"]
    nested = spark.sql("SELECT array(array(1, null), null) AS a, map('k', array('v')) AS m")
    assert format_lines(nested).first().line == "[[1, null], null]\t{k=[v]}"
    assert debug_text(keyed).first().text == "[a:int=1,ds:string=d]"


@pytest.mark.parametrize("count", [1, 99, 100, 101, 250, 999, 1000, 1001, 5000])
def test_large_limit_is_exact(spark, tmp_path_factory, count):
    path = str(tmp_path_factory.mktemp("limit") / "t")
    spark.range(1000).repartition(7).write.parquet(path)
    source = spark.read.parquet(path)
    limited = limit_rows(source, count, in_place=True)
    ids = [r.id for r in limited.collect()]
    assert len(ids) == len(set(ids)) == min(count, 1000)
    assert limited.columns == ["id"]
    plan = limited._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Limit" not in plan
    assert limit_rows(source, count).count() == min(count, 1000)


@pytest.mark.parametrize("count", [1, 40, 99, 101, 333, 334])
def test_large_limit_of_chosen_rows(spark, tmp_path, count):
    """Conditions on columns, splits of a set number, and files without a row that passes."""
    path = str(tmp_path / "t")
    spark.range(1000).repartition(5).write.parquet(path)
    spark.range(20).where("id % 3 > 0").coalesce(1).write.mode("append").parquet(path)
    source = read_table(spark, ReadSpec(path=path, num_splits=3)).where("id % 3 = 0 AND id < 1000")
    ids = [r.id for r in limit_rows(source, count, in_place=True).collect()]
    assert len(ids) == len(set(ids)) == count and all(i % 3 == 0 for i in ids)


def test_large_limit_reads_the_data_once(spark, tmp_path):
    """Counting takes footers alone: no column is read until the rows are."""
    path = str(tmp_path / "t")
    spark.range(10_000).select("id", F.col("id").cast("string").alias("s")).repartition(4).write.parquet(path)
    scans = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda v: scans.add(1) or v, "string")
    limited = limit_rows(spark.read.parquet(path).withColumn("s", counted("s")), 6000, in_place=True)
    assert scans.value == 0
    assert limited.select(F.max("s"), F.count("s")).first()[1] == 6000
    assert scans.value == 6000


def test_negative_limit_is_refused(spark):
    with pytest.raises(ValueError, match="negative"):
        limit_rows(spark.range(1), -1)
    assert limit_rows(spark.range(1), 0, in_place=True).count() == 0


def test_limit_reads_no_more_files_than_it_needs(spark, tmp_path):
    """Ten rows a file; a file that no reader can open lies behind them, and a partition filter before."""
    cores = spark.sparkContext.defaultParallelism
    for i in range(3 * cores):
        rows = spark.range(10 * i, 10 * i + 10).coalesce(1).toArrow()
        folder = tmp_path / f"ds=d {i % 2}"
        folder.mkdir(exist_ok=True)
        pq.write_table(rows, folder / f"f{i:04}.parquet")
    (tmp_path / "ds=d 1" / "z.parquet").write_text("no parquet")
    scan = spark.read.schema("id bigint, ds string").parquet(str(tmp_path)).select("id", "ds")
    for count in (1, 10 * cores, 10 * cores + 1, 20 * cores - 5):
        limited = limit_rows(scan, count, in_place=True)
        assert "SinglePartition" not in limited._jdf.queryExecution().executedPlan().toString()
        ids = [row["id"] for row in limited.collect()]
        assert len(ids) == len(set(ids)) == count
    chosen = scan.where("ds = 'd 0'")
    for count in (15, 10**6):
        ids = [row["id"] for row in limit_rows(chosen, count, in_place=True).collect()]
        assert len(ids) == len(set(ids)) == min(count, chosen.count())
