"""Registered queries: delimited text written from the driver tables and decoded again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.observe import observe_success, read_metrics
from tablegate.plans.registry import given, layout, query
from tablegate.sinks.text import write_delimited, write_lines
from tablegate.sources.faults import split_malformed
from tablegate.sources.tables import read_table
from tablegate.spec import TAB_SEPARATED, ReadSpec
from tablegate.workspace import scratch_folder

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"


def _text(path: str, schema: str, **more: object) -> ReadSpec:
    return ReadSpec(
        path=path,
        format="delimited",
        schema=T.DataType.fromDDL(schema),
        delimited=TAB_SEPARATED,
        **more,
    )


def _raw_lines(rows: DataFrame, *fields: Column) -> str:
    """Write ready-made field texts as tab-separated lines; returns the path."""
    path = scratch_folder(rows.sparkSession)
    write_lines(rows.select(F.concat_ws("\t", *fields).alias("value")), path)
    return path


@layout
def customer_text(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_folder(spark)
    columns = ("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    write_delimited(given(spark, sf_dir, "customer", *columns), path, TAB_SEPARATED)
    return path


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _text(customer_text(spark, sf_dir), CUSTOMER))


@query("SELECT o_orderkey, o_totalprice, o_orderstatus AS value FROM orders")
def text_key_named_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited text whose partition key has the name that Spark gives a text line."""
    path = scratch_folder(spark)
    orders = given(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderstatus")
    rows = orders.withColumnRenamed("o_orderstatus", "value")
    write_delimited(rows, path, TAB_SEPARATED, partition_keys=("value",))
    schema = "o_orderkey bigint, o_totalprice double"
    return read_table(spark, _text(path, schema, partition_keys=("value",)))


@query("SELECT c_nationkey, c_custkey FROM customer")
def text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _text(customer_text(spark, sf_dir), CUSTOMER, columns=("c_nationkey", "c_custkey"))
    return read_table(spark, spec)


@query(
    """SELECT 'lazy' AS mode, c_custkey, c_acctbal FROM customer
       UNION ALL SELECT 'bytes', c_custkey, c_acctbal FROM customer"""
)
def text_parse_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("c_custkey", "c_acctbal")
    path = customer_text(spark, sf_dir)
    lazy, by_bytes = (
        read_table(spark, _text(path, CUSTOMER, columns=columns, parse_mode=mode)).select(
            F.lit(mode).alias("mode"), *columns
        )
        for mode in ("lazy", "bytes")
    )
    return lazy.unionByName(by_bytes)


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
              CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_name END AS c_name FROM customer"""
)
def text_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``\\N`` and empty fields: null for numbers, empty for strings."""
    key = F.col("c_custkey")
    nation = (
        F.when(key % 6 == 0, "").when(key % 3 == 0, "\\N")
        .otherwise(F.col("c_nationkey").cast("string"))
    )
    name = F.when(key % 4 == 0, "").otherwise(F.col("c_name"))
    rows = given(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_name")
    path = _raw_lines(rows, key.cast("string"), nation, name)
    return read_table(spark, _text(path, "c_custkey bigint, c_nationkey int, c_name string"))


@query(
    """SELECT event_id, CASE event_type WHEN 'view' THEN true WHEN 'click' THEN false END AS flag
       FROM events"""
)
def text_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the two full words count, in any letter case."""
    kind = F.col("event_type")
    flag = (
        F.when(kind == "view", "TrUe").when(kind == "click", "FALSE").when(kind == "error", "t")
        .when(kind == "signup", "true ").otherwise("")
    )
    rows = given(spark, sf_dir, "events", "event_id", "event_type")
    path = _raw_lines(rows, F.col("event_id").cast("string"), flag)
    return read_table(spark, _text(path, "event_id bigint, flag boolean"))


@query(
    """SELECT o_orderkey,
         CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN CAST(7 AS TINYINT)
              WHEN 2 THEN CAST(-7 AS TINYINT) WHEN 3 THEN CAST(0 AS TINYINT) WHEN 4 THEN NULL
              WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE NULL END AS small,
         CASE o_orderkey % 8 WHEN 0 THEN o_custkey WHEN 1 THEN -o_custkey WHEN 2 THEN NULL
              WHEN 3 THEN NULL WHEN 4 THEN CAST('9223372036854775807' AS BIGINT)
              WHEN 5 THEN CAST('-9223372036854775808' AS BIGINT) WHEN 6 THEN NULL
              ELSE NULL END AS big,
         CASE o_orderkey % 8 WHEN 0 THEN o_totalprice WHEN 1 THEN -o_totalprice
              WHEN 2 THEN o_custkey * 1e5 WHEN 3 THEN CAST('Infinity' AS DOUBLE)
              WHEN 4 THEN CAST('-Infinity' AS DOUBLE) WHEN 5 THEN NULL WHEN 6 THEN NULL
              ELSE NULL END AS num
       FROM orders"""
)
def text_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signs, limits, exponents, overflow and malformed digits."""
    form = F.col("o_orderkey") % 8
    customer, price = (F.col(name).cast("string") for name in ("o_custkey", "o_totalprice"))

    def by_form(*texts: Column | str) -> Column:
        chosen = F.lit(None).cast("string")
        for number, text in reversed(list(enumerate(texts))):
            value = F.lit(text) if isinstance(text, str) else text
            chosen = F.when(form == number, value).otherwise(chosen)
        return chosen

    small = by_form("200", "+7", "-7", "-0", "x", "-", "1.5", "")
    big = by_form(
        F.concat(F.lit("+"), customer), F.concat(F.lit("-"), customer), "9223372036854775808",
        F.concat(F.lit(" "), customer), "9223372036854775807", "-9223372036854775808",
        F.concat(customer, F.lit(" ")), "\\N",
    )
    number = by_form(
        price, F.concat(F.lit("-"), price), F.concat(customer, F.lit("e5")), "Infinity",
        "-Infinity", "inf", "nan", "1e",
    )
    rows = given(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    path = _raw_lines(rows, F.col("o_orderkey").cast("string"), small, big, number)
    return read_table(
        spark, _text(path, "o_orderkey bigint, small tinyint, big bigint, num double")
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey + l_suppkey AS list_sum, l_quantity AS qty,
              2 AS list_size FROM lineitem"""
)
def text_list_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    )
    path = scratch_folder(spark)
    rows = lines.select(
        "l_orderkey",
        "l_linenumber",
        F.array("l_partkey", "l_suppkey").alias("keys"),
        F.create_map(F.lit("qty"), F.col("l_quantity")).alias("amounts"),
    )
    write_delimited(rows, path, TAB_SEPARATED)
    schema = "l_orderkey bigint, l_linenumber int, keys array<bigint>, amounts map<string,double>"
    return read_table(spark, _text(path, schema)).select(
        "l_orderkey",
        "l_linenumber",
        F.aggregate("keys", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("list_sum"),
        F.col("amounts")["qty"].alias("qty"),
        F.size("keys").alias("list_size"),
    )


@query(
    """SELECT s_suppkey, s_nationkey AS nation, s_name AS name,
              CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE 2 END AS num_keys FROM supplier"""
)
def text_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Struct fields by position; an empty list field is an empty list."""
    suppliers = given(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey", "s_name")
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    keys = F.when(F.col("s_suppkey") % 2 == 0, "").otherwise(F.concat_ws(",", key, nation))
    path = _raw_lines(suppliers, key, F.concat_ws(",", nation, "s_name"), keys)
    schema = "s_suppkey bigint, place struct<nation:int,name:string>, keys array<bigint>"
    return read_table(spark, _text(path, schema)).select(
        "s_suppkey", "place.nation", "place.name", F.size("keys").alias("num_keys")
    )


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE p_size END AS p_size,
              CASE WHEN p_partkey % 2 = 0 OR p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS p_brand
       FROM part"""
)
def text_short_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields past the end of a line are null; surplus fields are ignored."""
    parts = given(spark, sf_dir, "part", "p_partkey", "p_size", "p_brand")
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    line = (
        F.when(F.col("p_partkey") % 2 == 0, key)
        .when(F.col("p_partkey") % 3 == 0, F.concat_ws("\t", key, size))
        .otherwise(F.concat_ws("\t", key, size, "p_brand", F.lit("surplus")))
    )
    path = _raw_lines(parts, line)
    return read_table(spark, _text(path, "p_partkey bigint, p_size int, p_brand string"))


@layout
def orders_compressed_text(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_folder(spark)
    columns = ("o_orderkey", "o_custkey", "o_orderstatus")
    orders = given(spark, sf_dir, "orders", *columns).withColumnRenamed("o_orderstatus", "ds")
    write_delimited(orders, path, TAB_SEPARATED, partition_keys=("ds",), compression="bzip2")
    return path


@query("SELECT o_orderkey, o_custkey, o_orderstatus AS ds FROM orders WHERE o_orderstatus IN ('O', 'P')")
def text_compressed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed text in partition directories; bzip2 files can still be split."""
    spec = _text(
        orders_compressed_text(spark, sf_dir), "o_orderkey bigint, o_custkey bigint",
        partition_keys=("ds",), partition_filter="ds IN ('O', 'P')",
    )
    return read_table(spark, spec)


def _customers_with_bad_keys(spark: SparkSession, sf_dir: str) -> str:
    rows = given(spark, sf_dir, "customer", "c_custkey", "c_name")
    key = F.when(F.col("c_custkey") % 10 == 0, "x").otherwise(F.col("c_custkey").cast("string"))
    return _raw_lines(rows, key, F.col("c_name"))


@query(
    """SELECT count(*) AS rows_read, count(*) FILTER (WHERE c_custkey % 10 = 0) AS bad_values,
              1 - count(*) FILTER (WHERE c_custkey % 10 = 0) / CAST(count(*) AS DOUBLE) AS ok_ratio
       FROM customer"""
)
def observed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row and bad-value counts collected while the text is decoded."""
    seen = Observation()
    spec = _text(_customers_with_bad_keys(spark, sf_dir), "c_custkey bigint, c_name string")
    metrics = read_metrics(read_table(spark, spec, observation=seen), seen)
    rows, bad = metrics["rows"], metrics["c_custkey_bad"]
    return spark.createDataFrame(
        [(rows, bad, 1 - bad / rows if rows else None)],
        "rows_read bigint, bad_values bigint, ok_ratio double",
    )


@layout
def malformed_lines(spark: SparkSession, sf_dir: str) -> str:
    """Path of ``lineitem`` as text by return flag: keys that are no number, quantities beyond it, a bad list item."""
    rows = given(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    number, key = F.col("l_linenumber"), F.col("l_orderkey")
    fields = (
        F.when(key % 7 == 0, F.concat(F.lit("k"), key)).otherwise(key.cast("string")),
        F.when(number == 3, "1.5.0").otherwise(F.col("l_quantity").cast("string")),
        F.concat_ws(",", F.col("l_partkey"), F.when(key % 11 == 0, "-").otherwise("5")),
    )
    path = scratch_folder(spark)
    lines = rows.select(F.concat_ws("\t", *fields).alias("line"), F.col("l_returnflag").alias("ds"))
    lines.hint("rebalance", "ds").write.partitionBy("ds").text(path)
    return path


MALFORMED = "l_orderkey bigint, l_quantity double, numbers array<bigint>"


@query(
    """WITH t AS (
         SELECT l_returnflag AS ds, l_orderkey % 7 = 0 AS bad_key, l_linenumber = 3 AS bad_quantity, l_orderkey % 11 = 0 AS bad_list,
                CASE WHEN l_orderkey % 7 = 0 THEN 'k' ELSE '' END || l_orderkey AS key_text,
                CASE WHEN l_linenumber = 3 THEN '1.5.0' ELSE CAST(l_quantity AS VARCHAR) END AS quantity_text,
                l_partkey || CASE WHEN l_orderkey % 11 = 0 THEN ',-' ELSE ',5' END AS list_text FROM lineitem)
       SELECT ds, key_text || chr(9) || quantity_text || chr(9) || list_text AS line,
              concat_ws(' ', CASE WHEN bad_key THEN 'l_orderkey:bigint:' || key_text END,
                        CASE WHEN bad_quantity THEN 'l_quantity:double:' || quantity_text END,
                        CASE WHEN bad_list THEN 'numbers:array<bigint>:' || list_text END) AS faults
       FROM t WHERE bad_key OR bad_quantity OR bad_list"""
)
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with a malformed value and what is wrong with it, set apart in the pass that decodes the others."""
    spec = _text(malformed_lines(spark, sf_dir), MALFORMED, partition_keys=("ds",))
    _, bad = split_malformed(spark, spec)
    return bad.select("ds", "line", _fault_text(F.col("faults")).alias("faults"))


def _fault_text(faults: Column) -> Column:
    return F.array_join(F.transform(faults, lambda f: F.concat_ws(":", f["column"], f["type"], f["text"])), " ")


@query(
    """SELECT l_orderkey, l_quantity, l_partkey + 5 AS total, l_returnflag AS ds FROM lineitem
       WHERE l_orderkey % 7 <> 0 AND l_linenumber <> 3 AND l_orderkey % 11 <> 0"""
)
def sound_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other side: the rows without a malformed value, decoded."""
    spec = _text(malformed_lines(spark, sf_dir), MALFORMED, partition_keys=("ds",))
    good, _ = split_malformed(spark, spec)
    total = F.aggregate("numbers", F.lit(0).cast("long"), lambda a, b: a + b)
    return good.select("l_orderkey", "l_quantity", total.alias("total"), "ds")


@query(
    """SELECT count(*) AS attempts, count(*) FILTER (WHERE c_custkey % 10 <> 0) AS successes
       FROM customer"""
)
def read_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = Observation()
    spec = _text(_customers_with_bad_keys(spark, sf_dir), "c_custkey bigint, c_name string")
    rows = observe_success(read_table(spark, spec), seen, F.col("c_custkey").isNotNull())
    metrics = read_metrics(rows, seen)
    return spark.createDataFrame(
        [(metrics["attempts"], metrics["successes"])], "attempts bigint, successes bigint"
    )


@layout
def customer_text_columns(spark: SparkSession, sf_dir: str) -> str:
    """Path of ``customer`` as Parquet whose columns are all text, with null texts and bad digits."""
    path = scratch_folder(spark)
    key = F.col("c_custkey")
    customers = given(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    customers.select(
        key.cast("string").alias("c_custkey"),
        F.when(key % 4 == 0, "\\N").otherwise(F.col("c_name")).alias("c_name"),
        F.when(key % 3 == 0, "").when(key % 5 == 0, "5x")
        .otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
        F.col("c_acctbal").cast("string").alias("c_acctbal"),
    ).write.parquet(path)
    return path


@query(
    """SELECT CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS c_name, c_custkey,
              CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END
              AS c_nationkey FROM customer"""
)
def columnar_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns held as text decode by the same rules; unwanted ones are not read."""
    spec = ReadSpec(
        path=customer_text_columns(spark, sf_dir),
        schema=T.DataType.fromDDL(CUSTOMER),
        columns=("c_name", "c_custkey", "c_nationkey"),
        text_columns=True,
    )
    return read_table(spark, spec)
