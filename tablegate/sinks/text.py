"""Text outputs: printed lines, delimited tables and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.encode import encode_line
from tablegate.sources.delimited import LINE
from tablegate.spec import DelimitedFormat, quote_name


def write_delimited(
    df: DataFrame,
    path: str,
    fmt: DelimitedFormat,
    *,
    partition_keys: tuple[str, ...] = (),
    mode: str = "errorifexists",
    compression: str | None = None,
    guard: bool = True,
) -> None:
    """Write ``df`` as a delimited text table, its keys as ``key=value`` directories.

    With keys, rows are first brought together by key. The rebalance splits
    a key that holds too many rows over several tasks and merges small ones,
    so no task gets a whole large partition and no directory fills with
    small files.
    """
    data = T.StructType([f for f in df.schema.fields if f.name not in partition_keys])
    keys = [F.col(quote_name(key)) for key in partition_keys]
    lines = df.select(encode_line(data, fmt, guard).alias(LINE), *keys)
    if partition_keys:
        lines = lines.hint("rebalance", *partition_keys)
    writer = lines.write.mode(mode).partitionBy(*partition_keys)
    if compression is not None:
        writer = writer.option("compression", compression)
    writer.text(path)


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write printed lines as text files."""
    lines.write.mode(mode).text(path)


def append_statistics(statistics: DataFrame, path: str) -> None:
    """Add statistics lines to a folder of CSV files."""
    statistics.write.mode("append").option("header", True).csv(path)
