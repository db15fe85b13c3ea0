"""Tables of several storage formats, found by listing."""

from __future__ import annotations

import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate import (
    TAB_SEPARATED, DelimitedFormat, FormatRule, ReadSpec, UnknownFormatError, read_by_format, write_delimited,
)
from tablegate.sources.formats import BY_NAME, glob_pattern, rules_in_use

DATA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def spec(path, **more):
    return ReadSpec(path=path, schema=DATA, partition_keys=("ds",), delimited=TAB_SEPARATED, **more)


@pytest.fixture
def table(spark, tmp_path):
    """Text (also compressed), ORC, JSON and Parquet; the ORC partition lacks the name."""
    path = str(tmp_path / "t")
    rows = lambda n: spark.range(n).withColumn("name", F.concat(F.lit("n"), F.col("id")))
    write_delimited(rows(2), f"{path}/ds=text", TAB_SEPARATED)
    write_delimited(rows(3), f"{path}/ds=gz", TAB_SEPARATED, compression="gzip")
    rows(4).drop("name").write.orc(f"{path}/ds=orc")
    rows(5).write.json(f"{path}/ds=a%2Fb")
    rows(6).write.parquet(f"{path}/ds=__HIVE_DEFAULT_PARTITION__")
    return path


def counts(frame):
    return {r["ds"]: (r["n"], r["named"]) for r in frame.groupBy("ds").agg(F.count("*").alias("n"), F.count("name").alias("named")).collect()}


def test_every_format_is_found(spark, table):
    assert counts(read_by_format(spark, spec(table))) == {"text": (2, 2), "gz": (3, 3), "orc": (4, 0), "a/b": (5, 5), None: (6, 6)}
    assert [BY_NAME[i].format for i in rules_in_use(spark, spec(table), BY_NAME)] == ["parquet", "orc", "json", "delimited"]


def test_columns_filter_and_order(spark, table):
    some = read_by_format(spark, spec(table, partition_filter="ds IN ('orc', 'gz')", columns=("name", "id")))
    assert some.columns == ["name", "id", "ds"]
    assert sorted(map(str, some.where("id = 2").collect())) == sorted(
        ["Row(name=None, id=2, ds='orc')", "Row(name='n2', id=2, ds='gz')"]
    )
    assert [BY_NAME[i].format for i in rules_in_use(spark, spec(table, partition_filter="ds = 'orc'"), BY_NAME)] == ["orc"]
    only_keys = read_by_format(spark, spec(table, columns=("ds",)))
    assert only_keys.count() == 20 and only_keys.columns == ["ds"]
    assert read_by_format(spark, spec(table, partition_filter="ds = 'none'")).isEmpty()
    with pytest.raises(AnalysisException):
        read_by_format(spark, spec(table, partition_filter="id = 1"))


def test_each_scan_opens_its_own_files_only(spark, table):
    """Parquet and ORC in one folder: neither reader meets the other's files."""
    spark.range(10, 13).withColumn("name", F.lit("x")).write.mode("append").parquet(f"{table}/ds=orc")
    assert counts(read_by_format(spark, spec(table)))["orc"] == (7, 3)


def test_files_without_a_rule_are_an_error(spark, table, tmp_path):
    (tmp_path / "t" / "ds=text" / "000000_0").write_text("9\tn9\n")
    with pytest.raises(UnknownFormatError, match="000000_0"):
        read_by_format(spark, spec(table))
    # not selected: not looked at
    assert read_by_format(spark, spec(table, partition_filter="ds = 'gz'")).count() == 3
    named = FormatRule("delimited", "0*_[0-9]", where="ds = 'text'")
    assert counts(read_by_format(spark, spec(table), (*BY_NAME, named)))["text"] == (3, 3)
    with pytest.raises(UnknownFormatError, match="more than one"):
        read_by_format(spark, spec(table), (*BY_NAME, FormatRule("delimited", where="ds = 'text'")))
    with pytest.raises(AnalysisException):
        read_by_format(spark, spec(table), (FormatRule("parquet", where="id = 1"),))
    with pytest.raises(ValueError, match="path"):
        read_by_format(spark, ReadSpec(table="t"))


def test_rules_by_partition_with_own_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    for ds, separator in (("old", "|"), ("new", "\t")):
        (tmp_path / "t" / f"ds={ds}").mkdir(parents=True)
        (tmp_path / "t" / f"ds={ds}" / "part").write_text(separator.join(["n7", "7"] if ds == "old" else ["7", "n7"]) + "\n")
    old = FormatRule(
        "delimited", where="ds < 'n' OR ds > 'o'", schema=T.DataType.fromDDL("name string, id int"),
        delimited=DelimitedFormat(separators=("|",)),
    )
    rows = read_by_format(spark, spec(path), (old, FormatRule("delimited", where="ds = 'new'")))
    assert sorted(map(tuple, rows.collect())) == [(7, "n7", "new"), (7, "n7", "old")]


def test_ten_thousand_partitions(spark, tmp_path):
    """The listing is Spark's; what is read are the chosen partitions."""
    made = {}
    rows = spark.range(1).withColumn("name", F.lit("x")).coalesce(1)
    rows.write.parquet(str(tmp_path / "p"))
    rows.write.orc(str(tmp_path / "o"))
    write_delimited(rows, str(tmp_path / "d"), TAB_SEPARATED)
    for folder in "pod":
        [made[folder]] = [f for f in (tmp_path / folder).iterdir() if f.name.startswith("part")]
    for i in range(10_000):
        source = made["pod"[i % 3]]
        (tmp_path / "t" / f"ds={i:05}").mkdir(parents=True)
        shutil.copyfile(source, tmp_path / "t" / f"ds={i:05}" / source.name)
    path = str(tmp_path / "t")
    # the default gives each folder a task of its own, which takes a minute on one machine
    other = spark.newSession()
    other.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
    assert rules_in_use(other, spec(path), BY_NAME) == [0, 1, 3]
    some = read_by_format(other, spec(path, partition_filter="ds >= '09990' AND ds < '09996'"))
    assert sorted(r["ds"] for r in some.collect()) == [f"{i:05}" for i in range(9990, 9996)]


@pytest.mark.parametrize(
    ("glob", "yes", "no"),
    [
        ("*.json{,.gz}", ["a.json", "a.json.gz", ".json"], ["a.jsonx", "ajson", "a.json.bz2"]),
        ("part-?[0-9]*", ["part-x1", "part-11.c"], ["part-1", "part-xx", "apart-x1"]),
        ("[!ab]x", ["cx"], ["ax", "bx", "x"]),
        ("a+b(1)$", ["a+b(1)$"], ["aab1"]),
    ],
)
def test_globs(spark, glob, yes, no):
    names = spark.createDataFrame([(n,) for n in yes + no], "n string")
    found = {r.n for r in names.where(F.col("n").rlike(glob_pattern(glob))).collect()}
    assert found == set(yes)
