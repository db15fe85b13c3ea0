"""Registered queries: statistics, estimates, units and throughput."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.units import convert_size
from tablegate.operators.catalog import partition_listing as listing_of
from tablegate.operators.stats import estimated_bytes as estimate
from tablegate.operators.stats import file_stats as files_of
from tablegate.operators.stats import partition_stats as stats_of
from tablegate.operators.stats import row_size, stored_selection_stats
from tablegate.operators.stats import selection_stats as totals_of
from tablegate.operators.stats import stored_stats as stored
from tablegate.plans import jobs
from tablegate.plans.registry import (
    create_table,
    events_by_day,
    given,
    layout,
    orders_by_status,
    query,
)
from tablegate.plans.text_queries import CUSTOMER, customer_text
from tablegate.sinks.tables import Output, write_outputs
from tablegate.sinks.text import append_statistics as append_lines
from tablegate.sources.partitions import NULL_PARTITION
from tablegate.sources.partitions import list_partitions as partitions_of
from tablegate.sources.tables import read_table
from tablegate.spec import TAB_SEPARATED, ReadSpec, WriteSpec, quote_table
from tablegate.workspace import scratch_folder

PRIORITY = ("o_orderpriority",)


@query(
    """SELECT o_orderstatus AS ds, count(*) AS num_rows,
              CAST(sum(length(o_orderpriority)) AS BIGINT) AS raw_size
       FROM orders GROUP BY 1"""
)
def partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReadSpec(table=orders_by_status(spark, sf_dir), columns=PRIORITY)
    return stats_of(spark, spec).select("ds", "num_rows", "raw_size")


@layout
def customers_by_nation(spark: SparkSession, sf_dir: str) -> str:
    """Catalog table of ``customer`` with the nation as an INT partition key, and one partition without rows."""
    rows = given(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    columns = "c_custkey BIGINT, nation INT"
    table = create_table(spark, "customers_by_nation", columns, using="parquet PARTITIONED BY (nation)")
    rows.hint("rebalance", "c_nationkey").write.insertInto(table)
    spark.sql(f"ALTER TABLE {quote_table(table)} ADD PARTITION (nation = -1)")
    return table


@query(
    """SELECT CAST(c_nationkey AS VARCHAR) AS nation, count(*) AS num_rows,
              CAST(8 * count(c_custkey) AS BIGINT) AS raw_size FROM customer GROUP BY 1
       UNION ALL SELECT '-1', 0, 0"""
)
def empty_partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partition without rows has its line of statistics too."""
    return stats_of(spark, ReadSpec(table=customers_by_nation(spark, sf_dir))).select("nation", "num_rows", "raw_size")


@query(
    """SELECT CAST(c_nationkey AS VARCHAR) AS nation, count(*) AS num_rows FROM customer
       WHERE CAST(c_nationkey AS VARCHAR) < '2' OR CAST(c_nationkey AS VARCHAR) = '9' GROUP BY 1
       UNION ALL SELECT '-1', 0"""
)
def filter_compares_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One meaning of a filter on an INT key: '10' comes before '2' for the listing and the read alike."""
    spec = ReadSpec(table=customers_by_nation(spark, sf_dir), partition_filter="nation < '2' OR nation = '9'")
    read = read_table(spark, spec).groupBy(F.col("nation").alias("read")).agg(F.count(F.lit(1)).alias("n"))
    listed = partitions_of(spark, spec)
    joined = listed.join(read, listed["nation"].eqNullSafe(read["read"]), "full")
    return joined.select("nation", F.coalesce("n", F.lit(0).cast("long")).alias("num_rows"))


@query(
    """SELECT count(*) AS num_rows, sum(length(o_orderpriority)) / 1e6 AS raw_mb FROM orders
       WHERE o_orderstatus IN ('F','O')"""
)
def selection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReadSpec(
        table=orders_by_status(spark, sf_dir),
        columns=PRIORITY,
        partition_filter="ds IN ('F', 'O')",
    )
    return totals_of(spark, spec).select("num_rows", "raw_mb")


@query(
    """SELECT count(*) AS num_rows,
              CAST(sum(8 + 8 + 8 + 4 + strlen(l_returnflag) + strlen(l_linestatus)) AS BIGINT)
              AS raw_size FROM lineitem"""
)
def raw_row_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (
        "l_orderkey", "l_partkey", "l_quantity", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    lines = given(spark, sf_dir, "lineitem", *columns)
    return lines.agg(
        F.count(F.lit(1)).alias("num_rows"), F.sum(row_size(lines)).alias("raw_size")
    )


@query("""SELECT strftime(ts, '%Y-%m-%d') AS ds, true AS has_size FROM events GROUP BY 1""")
def file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ReadSpec(
        path=events_by_day(spark, sf_dir),
        schema=T.DataType.fromDDL("event_id bigint"),
        partition_keys=("ds",),
    )
    return files_of(spark, spec).select("ds", (F.col("total_size") > 0).alias("has_size"))


@query("SELECT o_orderstatus AS ds, count(*) AS num_rows FROM orders GROUP BY 1")
def stored_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics kept in the catalog by ANALYZE, read back without a scan."""
    table = orders_by_status(spark, sf_dir)
    spark.sql(f"ANALYZE TABLE {quote_table(table)} PARTITION (ds) COMPUTE STATISTICS")
    values = [row["ds"] for row in partitions_of(spark, ReadSpec(table=table)).collect()]
    rows = [(v, stored(spark, table, {"ds": v or NULL_PARTITION}).num_rows) for v in values]
    return spark.createDataFrame(rows, "ds string, num_rows bigint")


@query(
    """SELECT count(*) AS num_rows, true AS has_size FROM orders
       WHERE o_orderstatus IN ('F', 'P')"""
)
def stored_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the selected partitions together, as the writes left them in the catalog: no ANALYZE, no scan."""
    orders = given(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    table = create_table(spark, "orders_counted", "o_orderkey bigint, o_orderpriority string", ("ds",))
    columns = ("o_orderkey", "o_orderpriority")
    parts = {s: Output(WriteSpec(table, {"ds": s}), columns, F.col("o_orderstatus") == s) for s in "FOP"}
    write_outputs(orders, parts)
    total = stored_selection_stats(spark, ReadSpec(table=table, partition_filter="ds IN ('F', 'P')"))
    return spark.createDataFrame(
        [(total.num_rows, total.total_size > 0)], "num_rows bigint, has_size boolean"
    )


@query("SELECT o_orderstatus AS ds, count(*) AS num_rows, true AS has_files FROM orders GROUP BY 1")
def partition_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All partitions with what the catalog keeps of them, from one call."""
    table = orders_by_status(spark, sf_dir)
    spark.sql(f"ANALYZE TABLE {quote_table(table)} PARTITION (ds) COMPUTE STATISTICS")
    return listing_of(spark, ReadSpec(table=table)).select("ds", "num_rows", (F.col("total_size") > 0).alias("has_files"))


@query(
    """SELECT count(*) FILTER (WHERE o_orderstatus = 'F') / CAST(count(*) AS DOUBLE)
              * sum(length(o_orderpriority)) AS est_bytes FROM orders"""
)
def estimated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes a read of one partition stands for, from one pass over the table."""
    table = orders_by_status(spark, sf_dir)
    rows = read_table(spark, ReadSpec(table=table, columns=PRIORITY))
    totals = rows.agg(
        F.count_if(F.col("ds") == "F").alias("rows_read"),
        F.count(F.lit(1)).alias("num_rows"),
        F.sum(row_size(rows, PRIORITY)).alias("raw_size"),
    )
    return totals.select(
        estimate(F.col("rows_read"), F.col("num_rows"), F.col("raw_size")).alias("est_bytes")
    )


@query(
    """SELECT doc_id, n_chars / 1e3 AS kb, n_chars / 1048576.0::DOUBLE AS mib,
              n_chars * 8 / 1e6 AS mbit, n_chars * 16 / 1024.0::DOUBLE AS kibit16,
              n_chars * 1024.0::DOUBLE / 8 AS bytes_of_kibit FROM documents"""
)
def size_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = given(spark, sf_dir, "documents", "doc_id", "n_chars")
    return documents.select(
        "doc_id",
        convert_size("n_chars", "B", "KB").alias("kb"),
        convert_size("n_chars", "B", "MiB").alias("mib"),
        convert_size("n_chars", "B", "Mbit").alias("mbit"),
        convert_size("n_chars", "B", "Kibit", word_size=16).alias("kibit16"),
        convert_size("n_chars", "Kibit", "B").alias("bytes_of_kibit"),
    )


@query(
    """SELECT doc_id, 1.7976931348623157e308::DOUBLE * sign(n_chars - 300) AS saturated
       FROM documents"""
)
def saturated_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product past the largest double stays there, on both sides of zero."""
    documents = given(spark, sf_dir, "documents", "doc_id", "n_chars")
    huge = F.signum(F.col("n_chars") - 300) * F.lit(1e300)
    return documents.select("doc_id", convert_size(huge, "PB", "B").alias("saturated"))


@query("SELECT count(*) AS rows, count(*) * 24 / 1e6 AS mb FROM lineitem")
def input_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The throughput read; times vary, so only rows and megabytes are returned."""
    columns = ("l_orderkey", "l_partkey", "l_extendedprice")
    spec = ReadSpec(path=f"{sf_dir}/lineitem.parquet", columns=columns)
    return jobs.input_benchmark(spark, spec).select("rows", "mb")


@query(
    """SELECT s.splits, count(*) AS rows FROM customer, (VALUES (1), (6), (11)) s(splits)
       GROUP BY 1"""
)
def split_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parse-only tail over text for several split counts, through the statistics file."""
    path = scratch_folder(spark)
    spec = ReadSpec(
        path=customer_text(spark, sf_dir),
        format="delimited",
        schema=T.DataType.fromDDL(CUSTOMER),
        delimited=TAB_SEPARATED,
    )
    for splits in (1, 6, 11):
        [line] = jobs.sweep(spark, spec, [splits])
        append_lines(line.select(F.lit(splits).alias("splits"), "rows"), path)
    return spark.read.schema("splits int, rows bigint").option("header", True).csv(path)
