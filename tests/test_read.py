"""Scans: columns, partitions, schema, formats, splits, unreadable files."""

from __future__ import annotations

import dataclasses
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate import (
    TAB_SEPARATED, FormatGroup, ReadSpec, list_files, list_partitions, qualified_name,
    read_mixed_formats, read_profiles, read_table, table_schema, tune_session, write_delimited,
)
from tablegate.operators.schema import TableSchema, UnknownColumnError

parse = T.DataType.fromDDL


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def text_file(folder, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part-0.txt").write_text("".join(f"{line}\n" for line in lines))


@pytest.fixture
def plain(tmp_path):
    text_file(tmp_path / "plain", ["17\t0.25", "-4\t8.5"])
    return str(tmp_path / "plain")


@pytest.fixture
def partitioned(tmp_path):
    text_file(tmp_path / "t" / "ds=2024-05-01", ["17\t0.25", "-4\t8.5"])
    return str(tmp_path / "t")


def delimited(path, schema="num int, ratio double", **more):
    return ReadSpec(
        path=path, format="delimited", schema=parse(schema), delimited=TAB_SEPARATED, **more
    )


def test_plain_table(spark, plain):
    rows = read_table(spark, delimited(plain))
    assert sorted(rows.collect()) == [(-4, 8.5), (17, 0.25)]
    # a table without partition keys ignores the filter
    filtered = read_table(spark, delimited(plain, partition_filter="ds = '2024-05-01'"))
    assert filtered.count() == 2


def test_partitioned_table(spark, partitioned):
    spec = delimited(partitioned, partition_keys=("ds",), partition_filter="ds = '2024-05-01'")
    rows = read_table(spark, spec)
    assert rows.columns == ["num", "ratio", "ds"]
    assert sorted(rows.collect()) == [(-4, 8.5, "2024-05-01"), (17, 0.25, "2024-05-01")]
    none = delimited(partitioned, partition_keys=("ds",), partition_filter="ds = 'other'")
    assert read_table(spark, none).isEmpty()


def test_all_types(spark, tmp_path):
    line = "-7\t300\t70000\t5000000000\tFALSE\t0.125\t-2e3\tsome words\t8,-9\tleft:0.5,right:-4"
    text_file(tmp_path / "t", [line])
    schema = (
        "tiny tinyint, small smallint, mid int, big bigint, flag boolean, f float, d double, "
        "word string, steps array<bigint>, sides map<string,float>"
    )
    for mode in ("lazy", "bytes"):
        row = read_table(spark, delimited(str(tmp_path / "t"), schema, parse_mode=mode)).first()
        assert tuple(row[:8]) == (-7, 300, 70000, 5_000_000_000, False, 0.125, -2000.0, "some words")
        assert row.steps == [8, -9]
        assert row.sides == {"left": 0.5, "right": -4.0}


def test_empty_lines_are_rows(spark, tmp_path):
    text_file(tmp_path / "t", ["", "a", ""])
    rows = read_table(spark, delimited(str(tmp_path / "t"), "s string"))
    assert sorted(r.s for r in rows.collect()) == ["", "", "a"]


@pytest.mark.parametrize("value", ["007", "a/b", "a=b", "100%", "x y", "a+b", "ü", "1.50"])
def test_partition_values_are_strings(spark, tmp_path, value):
    path = str(tmp_path / "t")
    rows = spark.range(3).withColumn("ds", F.lit(value))
    rows.write.partitionBy("ds").parquet(path)
    spec = ReadSpec(path=path, schema=parse("id bigint"), partition_keys=("ds",))
    assert {r.ds for r in read_table(spark, spec).collect()} == {value}
    inferred = ReadSpec(path=path, partition_keys=("ds",))
    assert {r.ds for r in read_table(spark, inferred).collect()} == {value}
    assert [tuple(r) for r in list_partitions(spark, spec).collect()] == [(value,)]
    [listed] = list_files(spark, path, ("ds",)).groupBy("ds").count().collect()
    assert listed.ds == value


def test_partitions_of_a_catalog_table(spark):
    spark.sql("CREATE TABLE parts_t (id BIGINT, ds STRING, hr INT) USING parquet PARTITIONED BY (ds, hr)")
    for ds, hr in (("a/b", 1), ("100%", 2), ("x=y+z", 10)):
        spark.sql(f"INSERT INTO parts_t PARTITION (ds='{ds}', hr={hr}) VALUES (1), (2)")
    every = list_partitions(spark, ReadSpec(table="parts_t"))
    assert sorted(every.collect()) == [("100%", "2"), ("a/b", "1"), ("x=y+z", "10")]
    some = list_partitions(spark, ReadSpec(table="parts_t", partition_filter="ds LIKE '%=%'"))
    assert [tuple(r) for r in some.collect()] == [("x=y+z", "10")]
    rows = read_table(spark, ReadSpec(table="parts_t", partition_filter="hr = '10'"))
    assert sorted(map(tuple, rows.collect())) == [(1, "x=y+z", "10"), (2, "x=y+z", "10")]
    assert rows.schema["hr"].dataType == T.StringType()


def test_filter_on_a_data_column_is_refused(spark, partitioned):
    spec = delimited(partitioned, partition_keys=("ds",), partition_filter="num = 1")
    with pytest.raises(AnalysisException):
        read_table(spark, spec)


def test_columns_in_the_asked_order(spark, partitioned):
    def columns(*names):
        spec = delimited(partitioned, partition_keys=("ds",), columns=names)
        return read_table(spark, spec).columns

    assert columns("ratio") == ["ratio", "ds"]
    assert columns("ratio", "num") == ["ratio", "num", "ds"]
    assert columns("ds", "ratio") == ["ds", "ratio"]
    assert columns("ds") == ["ds"]
    with pytest.raises(UnknownColumnError, match="D1"):
        columns("D1")


def test_only_wanted_partitions_and_columns_are_scanned(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).select(
        "id", (F.col("id") * 2).alias("twice"), F.col("id").cast("string").alias("text"),
        (F.col("id") % 2).alias("ds"),
    )
    rows.write.partitionBy("ds").parquet(path)
    spec = ReadSpec(
        path=path, schema=parse("id bigint, twice bigint, text string"), partition_keys=("ds",),
        columns=("twice",), partition_filter="ds = '1'",
    )
    read = read_table(spark, spec)
    plan = plan_of(read)
    assert "ReadSchema: struct<twice:bigint>" in plan
    assert "PartitionFilters: [isnotnull(ds" in plan and "Exchange" not in plan
    assert sorted(r.twice for r in read.collect()) == [2, 6, 10, 14, 18]


def test_old_partition_lacks_the_new_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(f"{path}/ds=old")
    spark.range(2).withColumn("extra", F.lit("x")).write.parquet(f"{path}/ds=new")
    spec = ReadSpec(
        path=path, schema=parse("id bigint, extra string"), partition_keys=("ds",)
    )
    assert sorted(map(tuple, read_table(spark, spec).collect()), key=repr) == sorted(
        [(0, None, "old"), (1, None, "old"), (0, "x", "new"), (1, "x", "new")], key=repr
    )


def test_text_and_columnar_partitions_in_one_table(spark, tmp_path):
    path = str(tmp_path / "t")
    text_file(tmp_path / "t" / "ds=a", ["1\tx", "2\ty"])
    spark.createDataFrame([(3, "z", 1.5)], "i int, s string, d double").write.orc(f"{path}/ds=b")
    spark.createDataFrame([(4,)], "i int").write.parquet(f"{path}/ds=c")
    groups = [
        FormatGroup("delimited", (f"{path}/ds=a",), parse("i int, s string"), TAB_SEPARATED),
        FormatGroup("orc", (f"{path}/ds=b",), parse("i int, s string, d double")),
        FormatGroup("parquet", (f"{path}/ds=c",), parse("i int")),
    ]
    spec = ReadSpec(path=path, schema=parse("i int, s string, d double"), partition_keys=("ds",))
    rows = read_mixed_formats(spark, path, groups, spec)
    assert sorted(map(tuple, rows.collect())) == [
        (1, "x", None, "a"), (2, "y", None, "a"), (3, "z", 1.5, "b"), (4, None, None, "c"),
    ]
    narrow = ReadSpec(
        path=path, schema=spec.schema, partition_keys=("ds",), columns=("d",),
        partition_filter="ds IN ('b', 'c')",
    )
    some = read_mixed_formats(spark, path, groups, narrow)
    assert sorted(map(tuple, some.collect()), key=repr) == [(1.5, "b"), (None, "c")]


@pytest.mark.parametrize("codec", ["gzip", "bzip2", "deflate"])
def test_compressed_text(spark, tmp_path, codec):
    path = str(tmp_path / codec)
    rows = spark.range(50).select("id", F.concat(F.lit("row "), "id").alias("text"))
    write_delimited(rows, path, TAB_SEPARATED, compression=codec)
    read = read_table(spark, delimited(path, "id bigint, text string"))
    assert sorted(read.collect()) == sorted(rows.collect())


def test_more_splits_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    text_file(tmp_path / "t", [f"{i}\t{i}.5" for i in range(20_000)])
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    rows = read_table(spark, delimited(path, num_splits=12))
    assert rows.rdd.getNumPartitions() == 12
    assert "Exchange" not in plan_of(rows)
    assert rows.agg(F.sum("num")).first()[0] == sum(range(20_000))
    few = read_table(spark, delimited(path, num_splits=2))
    assert few.rdd.getNumPartitions() == 2
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    # frames of the two sessions still combine
    assert rows.join(read_table(spark, delimited(path)), "num").count() == 20_000
    with pytest.raises(ValueError, match="num_splits"):
        read_table(spark, delimited(path, num_splits=0))


def test_fewer_splits_than_by_default(spark, tmp_path):
    for i in range(9):
        text_file(tmp_path / "t" / f"ds={i % 3}", [])
        (tmp_path / "t" / f"ds={i % 3}" / f"p{i}.txt").write_text("".join(f"{j}\t1.5\n" for j in range(100 * (i + 1))))
    spec = delimited(str(tmp_path / "t"), partition_keys=("ds",))
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "500")
    assert read_table(small, spec).rdd.getNumPartitions() > 30
    for splits in (1, 2, 6, 16):
        rows = read_table(small, dataclasses.replace(spec, num_splits=splits))
        assert rows.rdd.getNumPartitions() == splits and rows.count() == 4500
        some = read_table(small, dataclasses.replace(spec, num_splits=splits, partition_filter="ds = '1'"))
        assert some.rdd.getNumPartitions() == splits and some.count() == 1500


def test_unreadable_files_are_skipped_only_on_request(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(f"{path}/ds=good")
    (tmp_path / "t" / "ds=bad").mkdir()
    (tmp_path / "t" / "ds=bad" / "part-0.parquet").write_bytes(b"not a table")
    spec = ReadSpec(path=path, schema=parse("id bigint"), partition_keys=("ds",))
    with pytest.raises(Exception, match="(?i)parquet"):
        read_table(spark, spec).collect()
    skipping = ReadSpec(
        path=path, schema=parse("id bigint"), partition_keys=("ds",), skip_unreadable=True
    )
    seen = Observation()
    rows = read_table(spark, skipping, observation=seen)
    assert sorted(r.id for r in rows.collect()) == [0, 1, 2, 3, 4]
    assert seen.get["rows"] == 5 and seen.get["id_nulls"] == 0


def test_profiles(spark, plain, partitioned):
    frames = read_profiles(
        spark,
        {"vertex": delimited(plain), "edge": delimited(partitioned, partition_keys=("ds",))},
    )
    assert frames["vertex"].columns == ["num", "ratio"]
    assert frames["edge"].columns == ["num", "ratio", "ds"]


def test_specs_are_checked():
    with pytest.raises(ValueError, match="exactly one"):
        ReadSpec()
    with pytest.raises(ValueError, match="exactly one"):
        ReadSpec(table="t", path="p")
    with pytest.raises(ValueError, match="schema"):
        ReadSpec(path="p", format="delimited")
    assert qualified_name("t") == "default.t"
    assert qualified_name("t", "db") == "db.t" == qualified_name("db.t")


def test_schema(spark):
    spark.sql(
        "CREATE TABLE schema_t (id BIGINT, tags ARRAY<STRING>, ds STRING) "
        "USING parquet PARTITIONED BY (ds)"
    )
    schema = table_schema(spark, "default.schema_t")
    assert (schema.num_columns, schema.num_partition_keys) == (2, 1)
    assert [schema.position_of(n) for n in ("id", "tags", "ds")] == [0, 1, 2]
    assert [schema.column_kind(i) for i in range(2)] == ["LONG", "LIST"]
    with pytest.raises(UnknownColumnError, match="ID"):
        schema.position_of("ID")
    for position in (-1, 2):
        with pytest.raises(IndexError):
            schema.column_type(position)
    assert sorted(map(tuple, schema.as_frame(spark).collect())) == [
        (0, "id", "LONG", False), (1, "tags", "LIST", False), (2, "ds", "STRING", True),
    ]
    built = TableSchema(parse("a int, b string"), ("ds",))
    assert built.names == ("a", "b", "ds")


def test_scratch_space_follows_the_session(spark):
    from tablegate.workspace import scratch_folder

    assert scratch_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_folder(spark) != scratch_folder(spark)
    assert not Path(scratch_folder(spark)).exists()


def test_columns_held_as_text(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("1", "x", "1,2"), ("\\N", "\\N", ""), ("z", "", "3"), (None, None, None)]
    stored = spark.createDataFrame(rows, "i string, s string, l string")
    stored.write.orc(f"{path}/ds=a")
    spec = ReadSpec(
        path=path, format="orc", schema=parse("i int, s string, l array<int>"),
        partition_keys=("ds",), delimited=TAB_SEPARATED, text_columns=True,
    )
    seen = Observation()
    read = read_table(spark, spec, observation=seen)
    assert sorted(map(repr, map(tuple, read.collect()))) == sorted(
        map(repr, [(1, "x", [1, 2], "a"), (None, None, [], "a"), (None, "", [3], "a"),
                   (None, None, None, "a")])
    )
    assert (seen.get["i_nulls"], seen.get["i_bad"]) == (3, 1)
    one = read_table(spark, dataclasses.replace(spec, columns=("i",)))
    assert "ReadSchema: struct<i:string>" in plan_of(one)
    with pytest.raises(ValueError, match="columnar"):
        ReadSpec(path=path, text_columns=True)


def test_unreadable_files_of_a_catalog_table(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "part-bad.parquet").write_bytes(b"not a table")
    spark.sql(f"CREATE TABLE bad_t (id BIGINT) USING parquet LOCATION '{tmp_path / 't'}'")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_table(spark, ReadSpec(table="bad_t")).collect()
    assert read_table(spark, ReadSpec(table="bad_t", skip_unreadable=True)).count() == 5


def test_files_describe_themselves(spark, tmp_path):
    spark.range(5).withColumn("x", F.lit(1.5)).write.parquet(str(tmp_path / "t"))
    rows = read_table(spark, ReadSpec(path=str(tmp_path / "t"), columns=("x",)))
    assert rows.count() == 5 and "ReadSchema: struct<x:double>" in plan_of(rows)


def test_wide_text_is_decoded_in_small_methods(spark, tmp_path):
    """Past the size the JVM compiles, the fused method is given up for many small ones."""
    names = [f"c{i}" for i in range(40)]
    text_file(tmp_path / "t", ["\t".join(str(i + row) for i in range(40)) for row in range(5)])
    schema = ", ".join(f"{name} bigint" for name in names)
    tuned = tune_session(spark.newSession())
    rows = read_table(tuned, delimited(str(tmp_path / "t"), schema))
    assert sorted(map(tuple, rows.collect())) == [
        tuple(i + row for i in range(40)) for row in range(5)
    ]
    assert tuned.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") != "8000"
