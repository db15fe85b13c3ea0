"""Checks made on the driver before a write starts.

A check and the write after it are not one transaction. For a new partition
the write therefore claims it too, and of two jobs that both passed the check
one is refused; two jobs that fill one empty table can both pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tablegate.operators.schema import TableSchema, catalog_schema
from tablegate.sources.partitions import match_partition_spec, partition_clause
from tablegate.spec import WriteSpec, quote_table


class OutputCheckError(ValueError):
    """A write that must not start; ``reason`` names the check."""

    def __init__(self, reason: str, message: str) -> None:
        super().__init__(message)
        self.reason = reason


def check_exists(spark: SparkSession, spec: WriteSpec) -> None:
    if not spark.catalog.tableExists(spec.table):
        raise OutputCheckError("missing_table", f"table {spec.table} does not exist")


def check_layout(spark: SparkSession, spec: WriteSpec) -> tuple[TableSchema, dict[str, str]]:
    """Refuse bucketed and sorted tables and a wrong number of partition values.

    Returns the table's schema and the partition values in table key order.
    """
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(spec.table)}")
    refused = described.where(
        F.col("col_name").isin("Num Buckets", "Bucket Columns", "Sort Columns")
        & ~F.coalesce("data_type", F.lit("")).isin("", "[]", "-1", "0")
    ).collect()
    if refused:
        found = ", ".join(f"{row.col_name} {row.data_type}" for row in refused)
        raise OutputCheckError("bucketed_table", f"table {spec.table} is bucketed: {found}")
    schema = catalog_schema(spark, spec.table)
    keys = schema.partition_keys
    if keys and not spec.partition:
        raise OutputCheckError(
            "needs_partition", f"table {spec.table} is partitioned by {list(keys)}, the write is not"
        )
    if spec.partition and not keys:
        raise OutputCheckError(
            "extra_partition", f"table {spec.table} is not partitioned, the write is"
        )
    try:
        values = match_partition_spec(keys, spec.partition)
        if values:
            partition_clause(values)
    except ValueError as error:
        raise OutputCheckError("partition_keys", f"table {spec.table}: {error}") from error
    return schema, values


def check_partition_is_new(spark: SparkSession, spec: WriteSpec, values: Mapping[str, str]) -> None:
    if partition_exists(spark, spec, values):
        raise _taken(spec, values)


def partition_exists(spark: SparkSession, spec: WriteSpec, values: Mapping[str, str]) -> bool:
    found = spark.sql(f"SHOW PARTITIONS {quote_table(spec.table)} {partition_clause(values)}")
    return not found.isEmpty()


def _taken(spec: WriteSpec, values: Mapping[str, str]) -> OutputCheckError:
    return OutputCheckError("partition_exists", f"table {spec.table} already has partition {values}")


def claim_partition(spark: SparkSession, spec: WriteSpec, values: Mapping[str, str]) -> None:
    """Add an empty partition. The catalog lets only one of several writers do so; the others are refused."""
    try:
        spark.sql(f"ALTER TABLE {quote_table(spec.table)} ADD {partition_clause(values)}")
    except AnalysisException as error:
        if partition_exists(spark, spec, values):
            raise _taken(spec, values) from error
        raise


def release_partition(spark: SparkSession, spec: WriteSpec, values: Mapping[str, str]) -> None:
    """Take a claim back, with whatever rows were written under it."""
    spark.sql(f"ALTER TABLE {quote_table(spec.table)} DROP IF EXISTS {partition_clause(values)}")


@contextmanager
def claimed_partition(spark: SparkSession, spec: WriteSpec, values: Mapping[str, str]) -> Iterator[None]:
    """Hold a new partition while it is written; a failure takes it back. Until the commit it reads as empty."""
    claim_partition(spark, spec, values)
    try:
        yield
    except BaseException:
        release_partition(spark, spec, values)
        raise


def check_table_is_empty(spark: SparkSession, spec: WriteSpec) -> None:
    if not spark.table(spec.table).isEmpty():
        raise OutputCheckError("table_not_empty", f"table {spec.table} has existing data")


def check_output(
    spark: SparkSession, spec: WriteSpec, *, target_is_new: bool = True
) -> tuple[TableSchema, dict[str, str]]:
    """All checks: the table exists, its layout and partitioning agree, the target is new.

    With ``replace_partition`` an existing partition is allowed; the write
    swaps it out. Returns the table's schema and the partition values in
    table key order.
    """
    check_exists(spark, spec)
    schema, values = check_layout(spark, spec)
    if target_is_new and not values:
        check_table_is_empty(spark, spec)
    elif target_is_new and not spec.replace_partition:
        check_partition_is_new(spark, spec, values)
    return schema, values
