"""The jobs a user starts."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.access import as_rows, first_long_long_double, rows_from_positions
from tablegate.operators.limit import limit_rows
from tablegate.operators.lines import DEFAULT_SEPARATOR, format_lines
from tablegate.operators.observe import drain
from tablegate.operators.schema import table_schema
from tablegate.operators.stats import row_size, throughput_line
from tablegate.sinks.checks import check_output
from tablegate.sinks.tables import write_table
from tablegate.sinks.text import append_statistics
from tablegate.sources.tables import read_table
from tablegate.spec import ReadSpec, WriteSpec

BYTES_PER_MB = 1e6


def tail(
    spark: SparkSession,
    spec: ReadSpec,
    limit: int | None = None,
    separator: str = DEFAULT_SEPARATOR,
    contract: T.StructType | None = None,
    limit_in_place: bool = False,
) -> DataFrame:
    """Rows of a table as printed lines, in a ``line`` column.

    ``contract`` prints the fields of a row contract instead of all data
    columns. The limit is the last step, so showing or collecting the lines
    stops the scan early; ``limit_in_place`` is for counts beyond one task.
    """
    keys = table_schema(spark, spec).partition_keys
    rows = read_table(spark, spec)
    if contract is not None:
        rows, keys = as_rows(rows, contract), ()
    if limit is not None and limit_in_place:
        rows = limit_rows(rows, limit, in_place=True)
    lines = format_lines(rows, separator, keys)
    return lines if limit is None or limit_in_place else limit_rows(lines, limit)


def tail_parse_only(
    spark: SparkSession,
    spec: ReadSpec,
    limit: int | None = None,
    contract: T.StructType | None = None,
    append_stats_to: str | None = None,
) -> DataFrame:
    """Decode the rows, print nothing; returns the throughput line.

    The line can also be added to a folder of CSV files.
    """
    rows = read_table(spark, spec)
    if contract is not None:
        rows = as_rows(rows, contract)
    if limit is not None:
        rows = limit_rows(rows, limit)
    line = timed_read(spark, rows)
    if append_stats_to is not None:
        append_statistics(line, append_stats_to)
    return line


def timed_read(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Read every row under a timer; megabytes are raw bytes of the values, counted on the way."""
    seen = Observation()
    size = row_size(rows)
    observed = rows.withColumns({"__bytes": size, "__part": F.spark_partition_id()}).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("__bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.max("__part") + 1, F.lit(0)).alias("partitions"),
    )
    started = time.perf_counter()
    drain(observed)
    seconds = time.perf_counter() - started
    metrics = seen.get
    return throughput_line(
        spark, metrics["rows"], metrics["partitions"], metrics["bytes"] / BYTES_PER_MB, seconds
    )


def input_benchmark(spark: SparkSession, spec: ReadSpec) -> DataFrame:
    """Throughput of a full read of the first three columns as long, long, double."""
    names = table_schema(spark, spec).data.names[:3]
    chosen = spec if spec.columns else replace(spec, columns=tuple(names))
    return timed_read(spark, first_long_long_double(read_table(spark, chosen)))


def sweep(
    spark: SparkSession,
    spec: ReadSpec,
    split_counts: Iterable[int],
    limit: int | None = None,
    append_stats_to: str | None = None,
) -> list[DataFrame]:
    """The parse-only tail for each number of input splits, one throughput line each."""
    return [
        tail_parse_only(
            spark, replace(spec, num_splits=count), limit, append_stats_to=append_stats_to
        )
        for count in split_counts
    ]


def output_job(df: DataFrame, spec: WriteSpec, writers: int) -> None:
    """Checked write by ``writers`` parallel tasks under one commit."""
    write_table(df, replace(spec, num_files=writers), check=True)


def map_only_write(df: DataFrame, positions: str, spec: WriteSpec, *, check: bool = True) -> None:
    """Write rows given as maps of position to value; a narrow job, no shuffle."""
    target, _ = check_output(df.sparkSession, spec, target_is_new=check)
    write_table(rows_from_positions(df, positions, target.data), spec, check=check)
