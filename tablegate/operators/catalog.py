"""Partitions of a catalog table with what the catalog keeps about each."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.schema import table_schema
from tablegate.sources.partitions import NULL_PARTITION, check_partition_filter
from tablegate.spec import ReadSpec, quote_table

# Names under which a catalog keeps the statistics of a partition.
NUM_ROWS, NUM_FILES, TOTAL_SIZE = "numRows", "numFiles", "totalSize"


def _catalog(spark: SparkSession, table: str):
    state = spark._jsparkSession.sessionState()
    return state.catalog(), state.sqlParser().parseTableIdentifier(quote_table(table))


def partition_listing(spark: SparkSession, spec: ReadSpec) -> DataFrame:
    """One row per selected partition: the keys as strings, ``num_files``, ``num_rows``, ``total_size``.

    A single call lists the partitions with their parameters; the driver holds
    one row of each. What the catalog does not know is null. Statistics that
    ANALYZE made come before those kept by a write, which takes them away; a
    row count kept with another size than the present one is not believed.
    """
    if spec.table is None:
        raise ValueError("a partition listing needs a catalog table")
    keys = table_schema(spark, spec).partition_keys
    if not keys:
        raise ValueError("the table has no partition keys")
    catalog, name = _catalog(spark, spec.table)
    found = catalog.listPartitions(name, spark._jvm.scala.Option.empty()).iterator()
    rows = []
    while found.hasNext():
        part = found.next()
        values = part.spec()
        texts = (values.apply(key) for key in keys)
        rows.append((*(None if v == NULL_PARTITION else v for v in texts), *_numbers(part)))
    schema = T.StructType(
        [T.StructField(key, T.StringType()) for key in keys]
        + [T.StructField(name, T.LongType()) for name in ("num_files", "num_rows", "total_size")]
    )
    listed = spark.createDataFrame(rows, schema)
    if spec.partition_filter:
        check_partition_filter(spark, keys, spec.partition_filter)
        listed = listed.where(spec.partition_filter)
    return listed


def _numbers(part) -> tuple[int | None, int | None, int | None]:
    kept = dict(re.findall(rf"\b({NUM_ROWS}|{NUM_FILES}|{TOTAL_SIZE}) -> (\d+)", part.parameters().toString()))
    files, rows, size = (int(kept[k]) if k in kept else None for k in (NUM_FILES, NUM_ROWS, TOTAL_SIZE))
    if part.stats().isDefined():
        text = part.stats().get().simpleString()
        measured = int(re.search(r"(\d+) bytes", text)[1])
        counted = re.search(r"(\d+) rows", text)
        rows = int(counted[1]) if counted else rows if measured == size else None
        files, size = files if measured == size else None, measured
    return files, rows, size


def partition_numbers(
    spark: SparkSession, table: str, values: Mapping[str, str]
) -> tuple[int | None, int | None, int | None]:
    """Files, rows and bytes of one partition, as far as the catalog knows them."""
    catalog, name = _catalog(spark, table)
    return _numbers(catalog.getPartition(name, spark._jvm.PythonUtils.toScalaMap(dict(values))))


def partition_totals(listed: DataFrame) -> tuple[int, int | None, int | None]:
    """Partitions of a listing, and their sizes and rows added up; None where one of them is not known."""
    known = lambda name: F.count(name) == F.count(F.lit(1))
    total = listed.agg(
        F.count(F.lit(1)).alias("n"),
        *(
            F.when(known(name), F.coalesce(F.sum(name), F.lit(0).cast("long"))).alias(name)
            for name in ("total_size", "num_rows")
        ),
    ).first()
    return total["n"], total["total_size"], total["num_rows"]


def keep_row_count(spark: SparkSession, table: str, values: Mapping[str, str], rows: int, added: bool) -> None:
    """Keep in the catalog what a write left in a partition: its rows, files and bytes. Nothing is scanned.

    ``rows`` were written; with ``added`` they come on top of those that were
    there, whose number must be known for the sum to be.
    """
    catalog, name = _catalog(spark, table)
    spec = spark._jvm.PythonUtils.toScalaMap(dict(values))
    part = catalog.getPartition(name, spec)
    before = _numbers(part)[1] if added else 0
    files, size = _files_and_bytes(spark, part)
    parameters = part.parameters().removed(NUM_ROWS)
    numbers = {NUM_FILES: files, TOTAL_SIZE: size}
    if before is not None:
        numbers[NUM_ROWS] = before + rows
    for key, number in numbers.items():
        parameters = parameters.updated(key, str(number))
    none = spark._jvm.scala.Option.empty()
    kept = part.copy(part.spec(), part.storage(), parameters, part.createTime(), part.lastAccessTime(), none)
    catalog.alterPartitions(name, spark._jvm.PythonUtils.toSeq([kept]))


def _files_and_bytes(spark: SparkSession, part) -> tuple[int, int]:
    """Files and bytes in a partition's folder, from the file system's summary; a folder without rows may be gone."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(part.location())
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(folder):
        return 0, 0
    held = system.getContentSummary(folder)
    return held.getFileCount() - int(system.exists(path(folder, "_SUCCESS"))), held.getLength()
