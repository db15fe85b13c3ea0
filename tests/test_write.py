"""Writes: round trips, checks, replacement, failure, file counts."""

from __future__ import annotations

import itertools
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate import (
    Output, OutputCheckError, ReadSpec, WriteSpec, check_output, map_only_write, new_rows, output_job,
    partition_listing, read_table, stored_selection_stats, stored_stats, write_outputs, write_profiles, write_table,
)
from tablegate.functions.text import escape_path_value, partition_path, unescape_path_value
from tablegate.functions.widening import WideningError
from tablegate.plans import read_queries  # noqa: F401
from tablegate.plans.registry import QUERIES, orders_by_status
from tablegate.sinks import checks
from tablegate.sinks.tables import MAX_RECORDS_PER_FILE
from tablegate.sinks.text import write_delimited
from tablegate.spec import TAB_SEPARATED

NUMBER = itertools.count()
SCHEMA = T.StructType().add("i1", T.IntegerType()).add("d1", T.DoubleType())


@pytest.fixture
def table(spark):
    name = f"default.w{next(NUMBER)}"
    spark.sql(f"CREATE TABLE {name} (i1 INT, d1 DOUBLE) USING parquet")
    return name


@pytest.fixture
def by_day(spark):
    name = f"default.p{next(NUMBER)}"
    spark.sql(f"CREATE TABLE {name} (i1 INT, d1 DOUBLE, ds STRING) USING parquet PARTITIONED BY (ds)")
    return name


@pytest.fixture
def rows(spark):
    return new_rows(spark, SCHEMA, [(1, 1.1), (2, 2.2)])


def contents(spark, name, **more):
    return sorted(map(tuple, read_table(spark, ReadSpec(table=name, **more)).collect()))


def reason(spec, rows):
    with pytest.raises(OutputCheckError) as caught:
        write_table(rows, spec)
    return caught.value.reason


def test_round_trip(spark, table, rows):
    write_table(rows, WriteSpec(table))
    assert contents(spark, table) == [(1, 1.1), (2, 2.2)]


def test_round_trip_of_a_partition(spark, by_day, rows):
    write_table(rows, WriteSpec(by_day, {"ds": "foobar"}))
    assert contents(spark, by_day, partition_filter="ds = 'foobar'") == [
        (1, 1.1, "foobar"), (2, 2.2, "foobar"),
    ]


@pytest.mark.parametrize("value", ["007", "a/b", "a=b", "100%", "it's", "back\\slash", 'q"', "a b", "a{b}", "{}"])
def test_awkward_partition_values(spark, by_day, rows, value):
    write_table(rows, WriteSpec(by_day, {"ds": value}))
    assert {r[2] for r in contents(spark, by_day)} == {value}
    assert reason(WriteSpec(by_day, {"ds": value}), rows) == "partition_exists"


@pytest.mark.parametrize("value", ["", None])
def test_empty_and_null_partition_values_are_refused(by_day, rows, value):
    assert reason(WriteSpec(by_day, {"ds": value}), rows) == "partition_keys"


def test_checks(spark, table, by_day, rows):
    assert reason(WriteSpec(f"{table}_missing"), rows) == "missing_table"
    assert reason(WriteSpec(by_day), rows) == "needs_partition"
    assert reason(WriteSpec(table, {"ds": "x"}), rows) == "extra_partition"
    assert reason(WriteSpec(by_day, {"day": "x"}), rows) == "partition_keys"
    assert reason(WriteSpec(by_day, {"ds": "x", "hr": "1"}), rows) == "partition_keys"
    assert contents(spark, table) == contents(spark, by_day) == []
    write_table(rows, WriteSpec(table))
    assert reason(WriteSpec(table), rows) == "table_not_empty"
    write_table(rows, WriteSpec(by_day, {"DS": "x"}))
    assert reason(WriteSpec(by_day, {"ds": "x"}), rows) == "partition_exists"
    check_output(spark, WriteSpec(by_day, {"ds": "y"}))
    assert len(contents(spark, table)) == len(contents(spark, by_day)) == 2


def test_bucketed_table_is_refused(spark, rows):
    name = f"default.b{next(NUMBER)}"
    spark.sql(f"CREATE TABLE {name} (i1 INT, d1 DOUBLE) USING parquet CLUSTERED BY (i1) INTO 4 BUCKETS")
    assert reason(WriteSpec(name), rows) == "bucketed_table"
    with pytest.raises(OutputCheckError):
        write_table(rows, WriteSpec(name), check=False)


def test_unchecked_write_appends(spark, table, by_day, rows):
    for _ in range(2):
        write_table(rows, WriteSpec(table), check=False)
        write_table(rows, WriteSpec(by_day, {"ds": "x"}), check=False)
    assert len(contents(spark, table)) == len(contents(spark, by_day)) == 4


def test_replacing_a_partition(spark, by_day, rows):
    for day in ("a", "b"):
        write_table(rows, WriteSpec(by_day, {"ds": day}))
    one = new_rows(spark, SCHEMA, [(9, 9.9)])
    write_table(one, WriteSpec(by_day, {"ds": "a"}, replace_partition=True))
    assert contents(spark, by_day) == [(1, 1.1, "b"), (2, 2.2, "b"), (9, 9.9, "a")]
    write_table(one, WriteSpec(by_day, {"ds": "new"}, replace_partition=True))
    assert len(contents(spark, by_day)) == 4


def test_a_partition_can_be_replaced_from_itself(spark, by_day, rows):
    write_table(rows, WriteSpec(by_day, {"ds": "a"}))
    same = read_table(spark, ReadSpec(table=by_day)).drop("ds").where("i1 = 1")
    write_table(same, WriteSpec(by_day, {"ds": "a"}, replace_partition=True))
    assert contents(spark, by_day) == [(1, 1.1, "a")]


def test_a_failed_replacement_keeps_the_old_rows(spark, by_day, rows):
    for day in ("a", "b{}"):
        write_table(rows, WriteSpec(by_day, {"ds": day}))
    before = contents(spark, by_day)
    bad = rows.withColumn("i1", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        write_table(bad, WriteSpec(by_day, {"ds": "a"}, replace_partition=True))
    assert contents(spark, by_day) == before
    write_table(rows.limit(0), WriteSpec(by_day, {"ds": "b{}"}, replace_partition=True))
    assert {r[2] for r in contents(spark, by_day)} == {"a"}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


@pytest.mark.parametrize("key", ["value", "ds"])
def test_text_with_any_key_name(spark, rows, tmp_path, key):
    path = str(tmp_path / "t")
    write_delimited(rows.withColumn(key, F.lit("k")), path, TAB_SEPARATED, partition_keys=(key,))
    spec = ReadSpec(path=path, format="delimited", delimited=TAB_SEPARATED, schema=SCHEMA, partition_keys=(key,))
    assert sorted(map(tuple, read_table(spark, spec).collect())) == [(1, 1.1, "k"), (2, 2.2, "k")]


def test_rows_of_any_status_are_laid_out(spark, tmp_path):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    status = F.when(F.col("o_orderkey") % 3 == 0, None).when(F.col("o_orderkey") % 5 == 0, "X")
    kept = F.when((F.col("o_orderkey") % 3 == 0) | (F.col("o_orderkey") % 5 == 0), status)
    odd = orders.withColumn("o_orderstatus", kept.otherwise(F.col("o_orderstatus")))
    odd.write.parquet(f"{tmp_path}/orders.parquet")
    for query in ("table_schema", "added_column", "mixed_formats"):
        assert QUERIES[query](spark, str(tmp_path)).count() > 0
    for query in ("added_column", "mixed_formats"):
        found = QUERIES[query](spark, str(tmp_path)).groupBy("ds").count().collect()
        assert sorted(map(tuple, found), key=str) == sorted(map(tuple, odd.groupBy("o_orderstatus").count().collect()), key=str)
    assert read_table(spark, ReadSpec(table=orders_by_status(spark, str(tmp_path)))).count() == orders.count()


def test_failed_write_leaves_nothing(spark, by_day, rows):
    bad = rows.withColumn(
        "i1", F.when(F.col("i1") == 2, F.raise_error(F.lit("boom")).cast("int")).otherwise(F.col("i1"))
    )
    with pytest.raises(Exception, match="boom"):
        write_table(bad, WriteSpec(by_day, {"ds": "x"}))
    assert contents(spark, by_day) == []
    assert spark.sql(f"SHOW PARTITIONS {by_day}").isEmpty()
    write_table(rows, WriteSpec(by_day, {"ds": "x"}))
    assert len(contents(spark, by_day)) == 2


def test_types_are_checked_before_the_write(spark, table):
    with pytest.raises(WideningError, match="i1: bigint into int"):
        write_table(spark.range(3).toDF("i1"), WriteSpec(table))
    write_table(spark.range(3).select(F.col("id").cast("int").alias("d1")), WriteSpec(table))
    assert sorted(read_table(spark, ReadSpec(table=table)).collect(), key=repr) == [
        (None, 0.0), (None, 1.0), (None, 2.0),
    ]


def test_number_and_size_of_files(spark, table, by_day):
    many = spark.range(1000).select(F.col("id").cast("int").alias("i1"), F.lit(0.5).alias("d1"))
    output_job(many, WriteSpec(table), writers=5)
    assert len(spark.table(table).inputFiles()) == 5
    before = spark.conf.get(MAX_RECORDS_PER_FILE)
    write_table(many.coalesce(1), WriteSpec(by_day, {"ds": "x"}, max_records_per_file=300))
    assert spark.conf.get(MAX_RECORDS_PER_FILE) == before
    sizes = spark.table(by_day).groupBy("_metadata.file_path").count().collect()
    assert sorted(r["count"] for r in sizes) == [100, 300, 300, 300]


def test_write_observation(spark, table, rows):
    seen = Observation()
    write_table(rows.withColumn("d1", F.lit(None).cast("double")), WriteSpec(table), observation=seen)
    assert seen.get == {"rows": 2, "i1_nulls": 0, "d1_nulls": 2}


def test_profiles_check_everything_first(spark, table, by_day, rows):
    outputs = {"one": (rows, WriteSpec(table)), "two": (rows, WriteSpec(by_day))}
    with pytest.raises(OutputCheckError):
        write_profiles(spark, outputs)
    assert contents(spark, table) == []
    outputs["two"] = (rows, WriteSpec(by_day, {"ds": "x"}))
    write_profiles(spark, outputs)
    assert len(contents(spark, table)) == len(contents(spark, by_day)) == 2


def test_map_only_job(spark):
    name = f"default.m{next(NUMBER)}"
    spark.sql(
        f"CREATE TABLE {name} (i1 BIGINT, i2 BIGINT, i3 BIGINT, ds STRING) "
        "USING parquet PARTITIONED BY (ds)"
    )
    splits = [{0: 23, 1: 34, 2: 45}, {0: 11, 1: 22, 2: 33}, {0: 67, 1: 78, 2: 89}, {0: 99, 1: 88, 2: 77}]
    frame = spark.createDataFrame([(m,) for m in splits], "m map<int,bigint>")
    map_only_write(frame, "m", WriteSpec(name, {"ds": "2013-04-01"}))
    assert contents(spark, name) == sorted((*m.values(), "2013-04-01") for m in splits)


def test_stored_statistics(spark, by_day, rows):
    write_table(rows, WriteSpec(by_day, {"ds": "a/b"}))
    kept = stored_stats(spark, by_day, {"ds": "a/b"})
    assert kept.num_rows == 2 and kept.total_size > 0
    spark.sql(f"ANALYZE TABLE {by_day} PARTITION (ds) COMPUTE STATISTICS")
    stats = stored_stats(spark, by_day, {"DS": "a/b"})
    assert stats == kept and (stats + stats).num_rows == 4
    # written past this library: nothing is known of the whole
    spark.sql(f"INSERT INTO {by_day} PARTITION (ds='c') VALUES (1, 1.0)")
    assert stored_selection_stats(spark, ReadSpec(table=by_day)) is None
    some = ReadSpec(table=by_day, partition_filter="ds <> 'c'")
    assert stored_selection_stats(spark, some) == stats
    assert stored_selection_stats(
        spark, ReadSpec(table=by_day, partition_filter="ds = 'none'")
    ).num_rows == 0


def test_row_counts_follow_the_writes(spark, by_day, rows):
    day = {"ds": "x{}y"}
    write_table(rows, WriteSpec(by_day, day))
    write_table(rows, WriteSpec(by_day, day), check=False)
    assert stored_stats(spark, by_day, day).num_rows == 4
    write_table(rows.limit(1), WriteSpec(by_day, day, replace_partition=True))
    assert stored_stats(spark, by_day, day).num_rows == 1
    write_table(rows.limit(0), WriteSpec(by_day, day, replace_partition=True))
    assert stored_stats(spark, by_day, day).num_rows == 0
    # rows on top of a number nobody knows
    spark.sql(f"INSERT INTO {by_day} PARTITION (ds='c') VALUES (1, 1.0)")
    write_table(rows, WriteSpec(by_day, {"ds": "c"}), check=False)
    found = stored_stats(spark, by_day, {"ds": "c"})
    assert found.num_rows is None and found.total_size > 0
    # a count that ANALYZE made goes when a write makes it wrong
    spark.sql(f"ANALYZE TABLE {by_day} PARTITION (ds) COMPUTE STATISTICS")
    write_table(rows, WriteSpec(by_day, {"ds": "c"}), check=False)
    assert stored_stats(spark, by_day, {"ds": "c"}).num_rows == 5
    listed = {r["ds"]: (r["num_rows"], r["num_files"]) for r in partition_listing(spark, ReadSpec(table=by_day)).collect()}
    assert listed["c"][0] == 5 and listed["c"][1] >= 3 and listed["x{}y"] == (0, 0)


def test_one_catalog_call_for_any_number_of_partitions(spark, by_day, monkeypatch):
    def calls():
        seen = []
        plain = type(spark).sql
        with monkeypatch.context() as patch:
            patch.setattr(type(spark), "sql", lambda self, *a, **k: seen.append(a) or plain(self, *a, **k))
            stored_selection_stats(spark, ReadSpec(table=by_day))
        return len(seen)

    spark.sql(f"ALTER TABLE {by_day} ADD PARTITION (ds='0')")
    few = calls()
    spark.sql(f"ALTER TABLE {by_day} ADD " + " ".join(f"PARTITION (ds='{i}')" for i in range(1, 200)))
    assert calls() == few


def test_of_two_writers_one_is_refused(spark, by_day, rows, monkeypatch):
    """Both have passed the check before either claims."""
    gate, plain = threading.Barrier(2), checks.check_partition_is_new
    monkeypatch.setattr(checks, "check_partition_is_new", lambda *a: (plain(*a), gate.wait()))

    def write(i):
        try:
            write_table(rows.withColumn("i1", F.lit(i)), WriteSpec(by_day, {"ds": "d"}))
        except OutputCheckError as error:
            return error.reason
        return i

    with ThreadPoolExecutor(2) as pool:
        outcomes = list(pool.map(write, range(2)))
    [winner] = [o for o in outcomes if o != "partition_exists"]
    assert len(outcomes) == 2 and {r[0] for r in contents(spark, by_day)} == {winner}
    assert len(contents(spark, by_day)) == 2


def test_writers_of_several_partitions_do_not_meet(spark, by_day, rows):
    """Side by side in one session, one of them failing; none deletes what another has or is writing."""
    bad = rows.withColumn("i1", F.raise_error(F.lit("boom")).cast("int"))

    def write(i):
        try:
            write_table(bad if i % 4 == 3 else rows.withColumn("i1", F.lit(i)), WriteSpec(by_day, {"ds": f"d{i}"}))
        except Exception as error:  # noqa: BLE001
            return "boom" in str(error)
        return True

    with ThreadPoolExecutor(4) as pool:
        assert all(pool.map(write, range(12)))
    assert {(r[0], r[2]) for r in contents(spark, by_day)} == {(i, f"d{i}") for i in range(12) if i % 4 != 3}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_failed_writer_leaves_no_partition(spark, by_day, rows):
    bad = rows.withColumn("i1", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        write_table(bad, WriteSpec(by_day, {"ds": "d"}))
    assert spark.sql(f"SHOW PARTITIONS {by_day}").isEmpty()
    write_table(rows, WriteSpec(by_day, {"ds": "d"}))
    with pytest.raises(Exception, match="boom"):
        write_table(bad, WriteSpec(by_day, {"ds": "d"}), check=False)
    assert len(contents(spark, by_day)) == 2


def test_profiles_are_taken_back_together(spark, table, by_day, rows):
    write_table(rows, WriteSpec(by_day, {"ds": "old"}))
    before = contents(spark, by_day)
    bad = rows.withColumn("d1", F.raise_error(F.lit("boom")).cast("double"))
    outputs = {
        "replaced": (rows.limit(1), WriteSpec(by_day, {"ds": "old"}, replace_partition=True)),
        "table": (rows, WriteSpec(table)),
        "new": (rows, WriteSpec(by_day, {"ds": "new"})),
        "bad": (bad, WriteSpec(by_day, {"ds": "bad"})),
    }
    with pytest.raises(Exception, match="boom"):
        write_profiles(spark, outputs)
    assert contents(spark, by_day) == before and contents(spark, table) == []
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {by_day}").collect()] == ["ds=old"]
    outputs["bad"] = (rows, WriteSpec(by_day, {"ds": "bad"}))
    write_profiles(spark, outputs)
    assert len(contents(spark, by_day)) == 5 and len(contents(spark, table)) == 2


def test_outputs_scan_their_parent_once(spark, table, by_day, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "p"))
    parent = spark.read.parquet(str(tmp_path / "p"))
    scans = spark.sparkContext.accumulator(0)
    counted = parent.withColumn("i1", F.udf(lambda v: scans.add(1) or v, "int")("i1"))
    outputs = {
        "a": Output(WriteSpec(table)),
        "b": Output(WriteSpec(by_day, {"ds": "one"}), ("i1",), "i1 = 1"),
        "c": Output(WriteSpec(by_day, {"ds": "both"}), (F.col("d1"), (F.col("i1") + 1).alias("i1"))),
    }
    write_outputs(counted, outputs)
    assert scans.value == 2
    assert contents(spark, table) == [(1, 1.1), (2, 2.2)]
    assert sorted(map(str, contents(spark, by_day, partition_filter="ds = 'one'"))) == ["(1, None, 'one')"]
    assert contents(spark, by_day, partition_filter="ds = 'both'") == [(2, 1.1, "both"), (3, 2.2, "both")]


def test_outputs_change_nothing_if_one_fails(spark, table, by_day, rows):
    boom = F.when(F.col("i1") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("i1")).cast("int").alias("i1")
    outputs = {"a": Output(WriteSpec(table)), "b": Output(WriteSpec(by_day, {"ds": "x"}), (boom,))}
    with pytest.raises(Exception, match="boom"):
        write_outputs(rows, outputs)
    assert contents(spark, table) == [] and spark.sql(f"SHOW PARTITIONS {by_day}").isEmpty()
    narrow = Output(WriteSpec(table), (F.col("d1").alias("i1"),))
    with pytest.raises(WideningError):
        write_outputs(rows, {"a": Output(WriteSpec(by_day, {"ds": "x"})), "b": narrow})
    two = {"a": Output(WriteSpec(by_day, {"ds": "x"})), "b": Output(WriteSpec(by_day, {"ds": "x"}), where="i1 = 1")}
    write_outputs(rows, two)
    assert len(contents(spark, by_day)) == 3 and stored_stats(spark, by_day, {"ds": "x"}).num_rows == 3



def test_partition_paths_match_the_directories_spark_makes(spark, tmp_path):
    values = [
        "plain", "a/b", "a=b", "100%", "x y", "a+b", "ü", "q\"'", "{[^]}", "a:b?c*d#e\\f", "t\tt", "\x7f",
    ]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, ds string")
    frame.write.partitionBy("ds").parquet(str(tmp_path / "t"))
    made = {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()}
    built = frame.select(partition_path({"ds": F.col("ds")}).alias("p"))
    assert {r.p for r in built.collect()} == made
    back = frame.select("ds", unescape_path_value(escape_path_value(F.col("ds"))).alias("again"))
    assert all(r.ds == r.again for r in back.collect())
    two = frame.limit(1).select(partition_path({"b": F.lit("1/2"), "a": F.lit(3)}).alias("p"))
    assert two.first().p == "b=1%2F2/a=3"
