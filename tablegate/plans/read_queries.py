"""Registered queries: scans, schema, typed access, lines and limits."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.access import (
    ID_ID_SIM,
    ID_ID_WEIGHT,
    as_rows,
    data_columns,
    first_long_long_double,
    get_map,
    require_type,
    rows_from_positions,
)
from tablegate.operators.access import null_sentinels as with_sentinels
from tablegate.operators.lines import debug_text, format_lines
from tablegate.operators.schema import table_schema as schema_of
from tablegate.plans.jobs import tail
from tablegate.plans.registry import (
    create_table,
    events_by_day,
    given,
    layout,
    orders_by_status,
    query,
)
from tablegate.sinks.text import write_delimited, write_lines
from tablegate.sources.faults import skipped_files as skipped_of
from tablegate.sources.formats import read_by_format
from tablegate.sources.partitions import list_files
from tablegate.sources.partitions import list_partitions as partitions_of
from tablegate.sources.tables import read_table
from tablegate.sources.tables import read_profiles as profiles_of
from tablegate.spec import TAB_SEPARATED, ReadSpec
from tablegate.workspace import scratch_folder

EVENT_COLUMNS = "event_id bigint, user_id bigint, event_type string, value double"


@query("SELECT * FROM customer")
def read_table_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, ReadSpec(path=f"{sf_dir}/customer.parquet"))


@query("SELECT p_name, p_partkey, p_retailprice FROM part")
def read_table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("p_name", "p_partkey", "p_retailprice")
    return read_table(spark, ReadSpec(path=f"{sf_dir}/part.parquet", columns=columns))


@query(
    """SELECT o_orderkey, o_totalprice, o_orderstatus AS ds FROM orders
       WHERE o_orderstatus = 'F'"""
)
def read_partition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReadSpec(
        table=orders_by_status(spark, sf_dir),
        columns=("o_orderkey", "o_totalprice"),
        partition_filter="ds = 'F'",
    )
    return read_table(spark, spec)


@query(
    """SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS ds FROM events
       WHERE strftime(ts, '%Y-%m-%d') >= '2024-01-10' AND strftime(ts, '%Y-%m-%d') < '2024-01-15'"""
)
def read_partition_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReadSpec(
        path=events_by_day(spark, sf_dir),
        schema=T.DataType.fromDDL(EVENT_COLUMNS),
        partition_keys=("ds",),
        columns=("event_id", "user_id"),
        partition_filter="ds >= '2024-01-10' AND ds < '2024-01-15'",
    )
    return read_table(spark, spec)


@query(
    """SELECT strftime(ts, '%Y-%m-%d') AS ds, event_id FROM events"""
)
def read_partition_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partition key among the named columns keeps its asked-for place."""
    spec = ReadSpec(
        path=events_by_day(spark, sf_dir),
        schema=T.DataType.fromDDL(EVENT_COLUMNS),
        partition_keys=("ds",),
        columns=("ds", "event_id"),
    )
    return read_table(spark, spec)


@query(
    """SELECT s.splits, l_returnflag, count(*) AS num_rows, CAST(sum(l_partkey) AS BIGINT) AS key_sum
       FROM lineitem, (VALUES (1), (6), (16)) s(splits) GROUP BY 1, 2"""
)
def read_with_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from so many splits of the text of a table, as counted by the scan."""
    spec = ReadSpec(
        path=lineitem_text(spark, sf_dir), format="delimited", delimited=TAB_SEPARATED,
        schema=T.DataType.fromDDL("l_returnflag string, l_partkey bigint"),
    )
    reads = []
    for splits in (1, 6, 16):
        rows = read_table(spark, replace(spec, num_splits=splits))
        found = F.lit(rows.rdd.getNumPartitions()).alias("splits")
        reads.append(
            rows.groupBy("l_returnflag")
            .agg(F.count(F.lit(1)).alias("num_rows"), F.sum("l_partkey").alias("key_sum"))
            .select(found, "l_returnflag", "num_rows", "key_sum")
        )
    return reduce(DataFrame.unionByName, reads)


@layout
def lineitem_text(spark: SparkSession, sf_dir: str) -> str:
    """Path of two columns of ``lineitem`` as delimited text, in files of about equal size."""
    path = scratch_folder(spark)
    write_delimited(given(spark, sf_dir, "lineitem", "l_returnflag", "l_partkey").repartition(4), path, TAB_SEPARATED)
    return path


@query("SELECT DISTINCT o_orderstatus AS ds FROM orders WHERE o_orderstatus <> 'P'")
def list_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReadSpec(table=orders_by_status(spark, sf_dir), partition_filter="ds <> 'P'")
    return partitions_of(spark, spec)


@query(
    """SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS ds FROM events
       WHERE strftime(ts, '%Y-%m-%d') LIKE '2024-01-1%'"""
)
def list_path_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReadSpec(
        path=events_by_day(spark, sf_dir),
        schema=T.DataType.fromDDL(EVENT_COLUMNS),
        partition_keys=("ds",),
        partition_filter="ds LIKE '2024-01-1%'",
    )
    return partitions_of(spark, spec)


@query(
    """SELECT strftime(ts, '%Y-%m-%d') AS ds, true AS has_files FROM events GROUP BY 1"""
)
def list_partition_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, events_by_day(spark, sf_dir), ("ds",))
    return files.groupBy("ds").agg((F.sum("file_size") > 0).alias("has_files"))


@query(
    """SELECT 0 AS position, 'o_orderkey' AS name, 'LONG' AS kind, false AS is_partition,
              count(o_orderkey) AS num_values FROM orders
       UNION ALL SELECT 1, 'o_custkey', 'LONG', false, count(o_custkey) FROM orders
       UNION ALL SELECT 2, 'o_totalprice', 'DOUBLE', false, count(o_totalprice) FROM orders
       UNION ALL SELECT 3, 'o_orderpriority', 'STRING', false, count(o_orderpriority) FROM orders
       UNION ALL SELECT 4, 'ds', 'STRING', true, count(o_orderstatus) FROM orders"""
)
def table_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema, next to how many values each of its columns holds."""
    table = orders_by_status(spark, sf_dir)
    schema = schema_of(spark, table)
    counts = read_table(spark, ReadSpec(table=table)).agg(
        *(F.count(name).alias(name) for name in schema.names)
    )
    values = counts.unpivot([], list(schema.names), "name", "num_values")
    # the schema has one row per column of the table
    described = F.broadcast(schema.as_frame(spark))
    return values.join(described, "name").select(
        "position", "name", "kind", "is_partition", "num_values"
    )


@query("SELECT l_orderkey AS id1, l_partkey AS id2, l_extendedprice AS weight FROM lineitem")
def typed_edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(spark, sf_dir, "lineitem", "l_extendedprice", "l_partkey", "l_orderkey")
    names = {"l_orderkey": "id1", "l_partkey": "id2", "l_extendedprice": "weight"}
    return as_rows(lines.withColumnsRenamed(names), ID_ID_WEIGHT)


@query("SELECT l_suppkey AS id1, l_partkey AS id2, l_discount AS sim FROM lineitem")
def similarity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_discount")
    return as_rows(lines.toDF("id1", "id2", "sim"), ID_ID_SIM)


@query(
    """SELECT count(*) AS num_rows, CAST(sum(l_orderkey + l_partkey) AS BIGINT) AS key_sum
       FROM lineitem"""
)
def parse_long_long_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_extendedprice")
    parsed = first_long_long_double(lines)
    return parsed.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.sum(F.col("l_orderkey") + F.col("l_partkey")).alias("key_sum"),
    )


@query("SELECT c_custkey, c_nationkey, c_acctbal, c_acctbal IS NULL AS no_balance FROM customer")
def strict_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = given(spark, sf_dir, "customer")
    balance = require_type(customers, "c_acctbal", "double")
    return customers.select(
        require_type(customers, 0, "bigint"),
        require_type(customers, "c_nationkey", "int"),
        balance,
        balance.isNull().alias("no_balance"),
    )


@query(
    """SELECT o_orderkey, COALESCE(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END,
              CAST('-9223372036854775808' AS BIGINT)) AS custkey FROM orders"""
)
def null_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sentinels(_orders_with_null_customers(spark, sf_dir).drop("o_orderpriority"))


def _orders_with_null_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    customer = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey"))
    return orders.select("o_orderkey", customer.alias("custkey"), "o_orderpriority")


@query(
    """SELECT s_suppkey, s_nationkey AS nation, CAST(s_nationkey AS VARCHAR) AS nation_text,
              s_name AS name_text FROM supplier"""
)
def struct_as_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs read as maps: fields of one type keep it, fields of several become text."""
    suppliers = given(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey", "s_name")
    rows = suppliers.select(
        "s_suppkey",
        F.struct(F.col("s_nationkey").alias("nation")).alias("same"),
        F.struct("s_nationkey", "s_name").alias("mixed"),
    )
    return rows.select(
        "s_suppkey",
        get_map(rows, "same")["nation"].alias("nation"),
        get_map(rows, "mixed")["s_nationkey"].alias("nation_text"),
        get_map(rows, "mixed")["s_name"].alias("name_text"),
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def row_without_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, ReadSpec(table=orders_by_status(spark, sf_dir)))
    return data_columns(rows, ("ds",))


@query("SELECT l_orderkey AS i1, l_partkey AS i2, l_suppkey AS i3, NULL::BIGINT AS i4 FROM lineitem")
def position_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.DataType.fromDDL("i1 bigint, i2 bigint, i3 bigint, i4 bigint")
    return rows_from_positions(lineitem_positions(spark, sf_dir), "positions", schema)


def lineitem_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` keys as one map of position to value per row."""
    columns = ("l_orderkey", "l_partkey", "l_suppkey")
    lines = given(spark, sf_dir, "lineitem", *columns)
    pairs = [part for i, name in enumerate(columns) for part in (F.lit(i), F.col(name))]
    return lines.select(F.create_map(*pairs).alias("positions"))


@layout
def orders_two_widths(spark: SparkSession, sf_dir: str) -> str:
    """Path of ``orders`` by status where partition F lacks the priority column."""
    path = scratch_folder(spark)
    orders = given(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    # a null status is no F: it stays with the others
    old = F.col("o_orderstatus").eqNullSafe("F")
    orders.where(old).select("o_orderkey").write.parquet(f"{path}/ds=F")
    orders.where(~old).withColumnRenamed("o_orderstatus", "ds").hint("rebalance", "ds").write.mode(
        "append"
    ).partitionBy("ds").parquet(path)
    return path


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END
              AS o_orderpriority, o_orderstatus AS ds FROM orders"""
)
def added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReadSpec(
        path=orders_two_widths(spark, sf_dir),
        schema=T.DataType.fromDDL("o_orderkey bigint, o_orderpriority string"),
        partition_keys=("ds",),
    )
    return read_table(spark, spec)


@layout
def orders_three_formats(spark: SparkSession, sf_dir: str) -> str:
    """Path of ``orders`` by status: F as delimited text, P as ORC, the others as Parquet."""
    path = scratch_folder(spark)
    orders = given(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    orders = orders.withColumnRenamed("o_orderstatus", "ds")
    write_delimited(orders.where("ds <=> 'F'").drop("ds"), f"{path}/ds=F", TAB_SEPARATED)
    orders.where("ds <=> 'P'").drop("ds").write.orc(f"{path}/ds=P")
    others = orders.where("NOT (ds <=> 'F' OR ds <=> 'P')").hint("rebalance", "ds")
    others.write.mode("append").partitionBy("ds").parquet(path)
    return path


@query("SELECT o_orderkey, o_custkey, o_orderstatus AS ds FROM orders")
def mixed_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each partition in its own format, which the files tell."""
    data = T.DataType.fromDDL("o_orderkey bigint, o_custkey bigint")
    path = orders_three_formats(spark, sf_dir)
    return read_by_format(spark, ReadSpec(path=path, schema=data, partition_keys=("ds",), delimited=TAB_SEPARATED))


@layout
def orders_with_bad_files(spark: SparkSession, sf_dir: str) -> str:
    """Path of ``orders`` by status where partition P holds text instead of Parquet, and E a file without rows."""
    path = scratch_folder(spark)
    orders = given(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    orders = orders.withColumnRenamed("o_orderstatus", "ds")
    orders.where("ds <> 'P'").hint("rebalance", "ds").write.partitionBy("ds").parquet(path)
    broken = orders.where("ds = 'P'").select(F.col("o_orderkey").cast("string"))
    broken.write.text(f"{path}/ds=P")
    orders.where(F.lit(False)).drop("ds").coalesce(1).write.parquet(f"{path}/ds=E")
    return path


@query("SELECT o_orderkey, o_orderstatus AS ds FROM orders WHERE o_orderstatus <> 'P'")
def skip_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReadSpec(
        path=orders_with_bad_files(spark, sf_dir),
        schema=T.DataType.fromDDL("o_orderkey bigint"),
        partition_keys=("ds",),
        skip_unreadable=True,
    )
    return read_table(spark, spec)


@query(
    """SELECT DISTINCT o_orderstatus AS ds, true AS unreadable, 0::BIGINT AS rows_read FROM orders WHERE o_orderstatus = 'P'
       UNION ALL SELECT 'E', false, 0"""
)
def skipped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which partitions lost files to ``skip_unreadable``, and which merely hold a file without rows."""
    spec = ReadSpec(
        path=orders_with_bad_files(spark, sf_dir), schema=T.DataType.fromDDL("o_orderkey bigint"), partition_keys=("ds",)
    )
    return skipped_of(spark, spec).groupBy("ds").agg(
        F.bool_or(F.col("reason") == "unreadable").alias("unreadable"), F.sum("rows_read").alias("rows_read")
    )


@query(
    """SELECT 'vertex' AS profile, count(*) AS num_rows, CAST(sum(c_custkey) AS BIGINT) AS key_sum
       FROM customer
       UNION ALL SELECT 'edge', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders"""
)
def read_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inputs of a graph job: vertices from one table, edges from another."""
    specs = {
        "vertex": ReadSpec(path=f"{sf_dir}/customer.parquet", columns=("c_custkey",)),
        "edge": ReadSpec(path=f"{sf_dir}/orders.parquet", columns=("o_orderkey", "o_custkey")),
    }
    totals = [
        rows.agg(
            F.lit(name).alias("profile"),
            F.count(F.lit(1)).alias("num_rows"),
            F.sum(rows.columns[0]).alias("key_sum"),
        )
        for name, rows in profiles_of(spark, specs).items()
    ]
    return reduce(DataFrame.unionByName, totals)


@layout
def null_customer_orders(spark: SparkSession, sf_dir: str) -> str:
    """Catalog table of ``orders`` by status with every fifth customer key null."""
    orders = given(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    customer = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey"))
    rows = orders.withColumn("o_custkey", customer).withColumnRenamed("o_orderstatus", "ds")
    data = "o_orderkey bigint, o_custkey bigint, o_orderpriority string"
    table = create_table(spark, "null_customer_orders", data, ("ds",))
    rows.hint("rebalance", "ds").write.insertInto(table)
    return table


@query(
    """SELECT concat_ws(chr(9), CAST(o_orderkey AS VARCHAR), COALESCE(CASE WHEN o_orderkey % 5 = 0
              THEN NULL ELSE CAST(o_custkey AS VARCHAR) END, 'null'), o_orderpriority) AS line
       FROM orders WHERE o_orderstatus = 'O'"""
)
def tail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = null_customer_orders(spark, sf_dir)
    return tail(spark, ReadSpec(table=table, partition_filter="ds = 'O'"))


@query("SELECT CAST(l_orderkey AS VARCHAR) || '|' || l_partkey || '|' || l_quantity AS line FROM lineitem")
def tail_row_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = T.DataType.fromDDL("l_orderkey bigint, l_partkey bigint, l_quantity double")
    spec = ReadSpec(path=f"{sf_dir}/lineitem.parquet")
    return tail(spark, spec, separator="|", contract=contract)


@query("SELECT concat_ws(chr(9), CAST(l_orderkey AS VARCHAR), l_partkey) AS value FROM lineitem")
def tail_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark)
    spec = ReadSpec(path=f"{sf_dir}/lineitem.parquet", columns=("l_orderkey", "l_partkey"))
    write_lines(tail(spark, spec), path)
    return spark.read.text(path)


@query(
    """SELECT '[' || l_partkey || ', ' || l_suppkey || ', null]' || chr(9) || '{flag='
              || l_returnflag || ', status=' || l_linestatus || '}' AS line FROM lineitem"""
)
def printed_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    rows = lines.select(
        F.array("l_partkey", "l_suppkey", F.lit(None)).alias("keys"),
        F.create_map(
            F.lit("flag"), F.col("l_returnflag"), F.lit("status"), F.col("l_linestatus")
        ).alias("flags"),
    )
    return format_lines(rows)


@query(
    """SELECT '[o_orderkey:bigint=' || o_orderkey || ',custkey:bigint='
              || COALESCE(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END,
              'null') || ']' AS text FROM orders"""
)
def row_debug_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debug_text(_orders_with_null_customers(spark, sf_dir).drop("o_orderpriority"))


# no two rows of lineitem agree on all of these; fewer columns are no key
ROW_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
LIMITED = f"""
SELECT count(*) AS num_rows, count(DISTINCT ({", ".join(ROW_KEY)})) AS num_keys
FROM (SELECT * FROM lineitem LIMIT {{}}) t
"""


def _count_lines(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("num_rows"), F.count_distinct("line").alias("num_keys"))


@query(LIMITED.format(100))
def tail_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReadSpec(path=f"{sf_dir}/lineitem.parquet", columns=ROW_KEY)
    return _count_lines(tail(spark, spec, limit=100))


@query(LIMITED.format(50_000))
def tail_limit_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parallel form of the limit, which large counts take."""
    spec = ReadSpec(
        path=f"{sf_dir}/lineitem.parquet", columns=ROW_KEY, num_splits=16
    )
    return _count_lines(tail(spark, spec, limit=50_000, limit_in_place=True))
