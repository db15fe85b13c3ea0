"""Table and partition statistics, estimates and throughput."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.units import to_megabytes
from tablegate.operators.catalog import partition_listing, partition_numbers, partition_totals
from tablegate.operators.schema import table_schema
from tablegate.sources.delimited import LINE
from tablegate.sources.partitions import (
    check_partition_filter,
    list_files,
    list_partitions,
    match_partition_spec,
)
from tablegate.sources.tables import choose_partitions, open_table
from tablegate.spec import ReadSpec, qualified_name, quote_name, quote_table

# Bytes a value of a fixed-width kind counts for.
FIXED_WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.LongType: 8,
    T.FloatType: 4,
    T.DoubleType: 8,
    T.DateType: 4,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def value_size(value: Column, dtype: T.DataType) -> Column:
    """Bytes of one value: fixed widths, text as UTF-8, collections by element; null is 0."""
    for fixed, width in FIXED_WIDTHS.items():
        if isinstance(dtype, fixed):
            return F.when(value.isNull(), F.lit(0)).otherwise(F.lit(width)).cast("long")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        size = F.octet_length(value).cast("long")
    elif isinstance(dtype, T.DecimalType):
        size = F.octet_length(value.cast("string")).cast("long")
    elif isinstance(dtype, T.ArrayType):
        size = _sum_of(value, dtype.elementType)
    elif isinstance(dtype, T.MapType):
        size = _sum_of(F.map_keys(value), dtype.keyType) + _sum_of(
            F.map_values(value), dtype.valueType
        )
    elif isinstance(dtype, T.StructType):
        size = F.lit(0).cast("long")
        for field in dtype.fields:
            size = size + value_size(value[field.name], field.dataType)
    else:
        raise TypeError(f"no size for {dtype.simpleString()}")
    return F.coalesce(size, F.lit(0).cast("long"))


def _sum_of(values: Column, dtype: T.DataType) -> Column:
    zero = F.lit(0).cast("long")
    for fixed, width in FIXED_WIDTHS.items():
        if isinstance(dtype, fixed):
            return F.coalesce(F.size(F.array_compact(values)).cast("long") * width, zero)
    return F.aggregate(values, zero, lambda total, v: total + value_size(v, dtype))


def row_size(df: DataFrame, columns: tuple[str, ...] = ()) -> Column:
    """Bytes of a row's values, over the named columns or all of them."""
    names = columns or df.columns
    size = F.lit(0).cast("long")
    for field in df.schema.fields:
        if field.name in names:
            size = size + value_size(df[quote_name(field.name)], field.dataType)
    return size


def partition_stats(
    spark: SparkSession, spec: ReadSpec, *, by_partition: bool = True
) -> DataFrame:
    """``num_files, num_rows, raw_size, total_size`` per partition, measured in one scan.

    Raw size covers the columns of ``spec`` (all data columns if none are
    named); for delimited text it is that of the lines. Rows are first added
    up per file, which spreads a partition of any size over many groups; what
    then comes together is one row per file. Every selected partition has a
    row, also one without rows. Files of a path are counted from the listing;
    of a catalog table, files that hold rows are.
    """
    schema, scan = open_table(spark, spec)
    rows = choose_partitions(spark, scan, schema, spec.partition_filter)
    keys = [F.col(quote_name(key)).cast("string").alias(key) for key in schema.partition_keys]
    measured = (LINE,) if spec.format == "delimited" else spec.columns or tuple(schema.data.names)
    sized = rows.select(
        *(keys if by_partition else ()),
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_size").alias("__file_size"),
        row_size(rows, measured).alias("__bytes"),
    )
    grouping = list(schema.partition_keys) if by_partition else []
    per_file = sized.groupBy(*map(quote_name, grouping), "__file").agg(
        F.count(F.lit(1)).alias("__rows"),
        F.sum("__bytes").alias("__bytes"),
        F.max("__file_size").alias("__file_size"),
    )
    measured_stats = per_file.groupBy(*map(quote_name, grouping)).agg(
        F.count(F.lit(1)).alias("num_files"),
        F.sum("__rows").alias("num_rows"),
        F.sum("__bytes").alias("raw_size"),
        F.sum("__file_size").alias("total_size"),
    )
    if not grouping:
        return measured_stats
    if spec.table is not None:
        return _with_all(list_partitions(spark, spec), measured_stats, grouping, COUNTED)
    return _with_all(file_stats(spark, spec), measured_stats.drop(*LISTED), grouping, COUNTED[1:3])


LISTED = ("num_files", "total_size")
COUNTED = ("num_files", "num_rows", "raw_size", "total_size")


def _with_all(partitions: DataFrame, found: DataFrame, keys: list[str], numbers: tuple[str, ...]) -> DataFrame:
    """One row per listed partition; numbers that ``found`` lacks are 0. Both sides have one row per partition."""
    named = found.withColumnsRenamed({key: f"__{key}" for key in keys})
    same = [partitions[quote_name(key)].eqNullSafe(named[quote_name(f"__{key}")]) for key in keys]
    joined = partitions.join(named, same, "left")
    zero = F.lit(0).cast("long")
    filled = joined.withColumns({name: F.coalesce(F.col(name), zero) for name in numbers})
    return filled.select(*map(quote_name, keys), *COUNTED)


def selection_stats(spark: SparkSession, spec: ReadSpec) -> DataFrame:
    """Statistics of all selected partitions together, with sizes in megabytes."""
    totals = partition_stats(spark, spec, by_partition=False)
    return totals.select(
        "num_files",
        F.coalesce("num_rows", F.lit(0).cast("long")).alias("num_rows"),
        F.coalesce("raw_size", F.lit(0).cast("long")).alias("raw_size"),
        F.coalesce("total_size", F.lit(0).cast("long")).alias("total_size"),
    ).withColumns(
        {"raw_mb": to_megabytes("raw_size"), "total_mb": to_megabytes("total_size")}
    )


def file_stats(spark: SparkSession, spec: ReadSpec) -> DataFrame:
    """``num_files`` and ``total_size`` per partition of a path, without opening a file."""
    if spec.path is None:
        raise ValueError("file statistics need a path")
    keys = list(spec.partition_keys)
    files = list_files(spark, spec.path, keys)
    if spec.partition_filter and keys:
        check_partition_filter(spark, keys, spec.partition_filter)
        files = files.where(spec.partition_filter)
    return files.groupBy(*map(quote_name, keys)).agg(
        F.count(F.lit(1)).alias("num_files"), F.sum("file_size").alias("total_size")
    )


@dataclass(frozen=True)
class StoredStats:
    """Statistics kept in the catalog; ``num_rows`` is unknown without an ANALYZE."""

    total_size: int
    num_rows: int | None

    def __add__(self, other: StoredStats) -> StoredStats:
        known = self.num_rows is not None and other.num_rows is not None
        return StoredStats(
            self.total_size + other.total_size,
            self.num_rows + other.num_rows if known else None,
        )


def stored_stats(
    spark: SparkSession, table: str, partition: Mapping[str, str] | None = None
) -> StoredStats | None:
    """What the catalog knows about a table or one partition; no scan. None if nothing."""
    table = qualified_name(table)
    if partition:
        keys = table_schema(spark, table).partition_keys
        _, rows, size = partition_numbers(spark, table, match_partition_spec(keys, partition))
        return None if size is None else StoredStats(size, rows)
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_table(table)}")
    row = described.where(F.col("col_name") == "Statistics").first()
    if row is None:
        return None
    size = re.search(r"(\d+) bytes", row.data_type)
    count = re.search(r"(\d+) rows", row.data_type)
    return StoredStats(int(size.group(1)) if size else 0, int(count.group(1)) if count else None)


def stored_selection_stats(spark: SparkSession, spec: ReadSpec) -> StoredStats | None:
    """Stored statistics of the selected partitions (or the whole table) added up; no scan.

    One catalog call, whatever the number of partitions. Row counts are those
    that :func:`write_table` kept or ANALYZE made; ``num_rows`` is None if one
    is not known, and the whole is None if the catalog lacks the size of any
    partition; :func:`selection_stats` then measures them.
    """
    if spec.table is None:
        raise ValueError("stored statistics need a catalog table")
    if not table_schema(spark, spec).partition_keys:
        return stored_stats(spark, spec.table)
    _, size, rows = partition_totals(partition_listing(spark, spec))
    return None if size is None else StoredStats(size, rows)


def estimated_bytes(rows_read: Column, num_rows: Column, raw_size: Column) -> Column:
    """Raw bytes a read of ``rows_read`` rows stands for, in proportion to the whole; 0 of a table without rows."""
    return F.when(num_rows == 0, F.lit(0.0)).otherwise(rows_read / num_rows.cast("double") * raw_size)


def throughput_line(
    spark: SparkSession, rows: int, partitions: int, mb: float, seconds: float
) -> DataFrame:
    """One row: rows, partitions, mb, seconds, rows_per_sec, mb_per_sec.

    Seconds are fractional, so a short run has a finite rate; a run that took
    no measurable time has none.
    """
    rate = (lambda amount: amount / seconds) if seconds > 0 else (lambda amount: None)
    return spark.createDataFrame(
        [(rows, partitions, float(mb), float(seconds), rate(rows), rate(mb))],
        "rows long, partitions int, mb double, seconds double, "
        "rows_per_sec double, mb_per_sec double",
    )
