"""Registry of the driver's queries, and the table layouts they share.

A layout is a driver table stored another way: partitioned, as text, with
injected nulls. It is written whole, once per application and input folder,
to the cluster's shared folder, and read by every query that needs it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.sinks.tables import write_table
from tablegate.sources.tables import read_table
from tablegate.spec import ReadSpec, WriteSpec, quote_table
from tablegate.workspace import scratch_database, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_LAYOUTS: dict[tuple[str, str, str], str] = {}

def query(sql: str | None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL it is checked against."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = " ".join(sql.split())
        return function

    return register


def layout(build: Callable[[SparkSession, str], str]) -> Callable[[SparkSession, str], str]:
    """Build a layout once per application and input folder; returns its table name or path."""

    @wraps(build)
    def once(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if key not in _LAYOUTS:
            _LAYOUTS[key] = build(spark, sf_dir)
        return _LAYOUTS[key]

    return once


def given(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Columns of a driver table (all if none are named)."""
    return read_table(spark, ReadSpec(path=f"{sf_dir}/{table}.parquet", columns=columns))


def create_table(
    spark: SparkSession,
    name: str,
    data: T.StructType | str,
    keys: tuple[str, ...] = (),
    using: str = "parquet",
) -> str:
    """Create an empty catalog table in a database of its own; returns its full name."""
    columns = data if isinstance(data, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in data.fields
    )
    table = f"{scratch_database(spark)}.{name}"
    columns += "".join(f", {key} STRING" for key in keys)
    partitioned = f"PARTITIONED BY ({', '.join(keys)})" if keys else ""
    spark.sql(f"CREATE TABLE {quote_table(table)} ({columns}) USING {using} {partitioned}")
    return table


@layout
def orders_by_status(spark: SparkSession, sf_dir: str) -> str:
    """Catalog table of ``orders`` with the status as partition key ``ds``.

    One pass with the key as a column: a status of any value, or null, has its
    partition, and one with most rows is split over several tasks and files.
    """
    orders = given(
        spark, sf_dir, "orders",
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus",
    )
    rows = orders.withColumnRenamed("o_orderstatus", "ds")
    table = create_table(spark, "orders_by_status", rows.drop("ds").schema, ("ds",))
    rows.hint("rebalance", "ds").write.insertInto(table)
    return table


@layout
def events_by_day(spark: SparkSession, sf_dir: str) -> str:
    """Path of ``events`` in one directory per day, key ``ds``.

    Rows are brought together by day first; a day of any size is split over
    several tasks and files.
    """
    path = scratch_folder(spark)
    events = given(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value", "ts")
    by_day = events.withColumn("ds", F.col("ts").cast("date").cast("string")).drop("ts")
    by_day.hint("rebalance", "ds").write.partitionBy("ds").parquet(path)
    return path
