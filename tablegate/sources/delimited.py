"""Delimited text: one row per line, fields by separator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.decode import PARSE_MODES, checked, split_text, undecodable
from tablegate.spec import DelimitedFormat, quote_name

# no partition key has this name
LINE = "__line"
FIELDS = "__fields"
BAD = "__bad"


def decode_lines(
    lines: DataFrame,
    schema: T.StructType,
    fmt: DelimitedFormat,
    columns: tuple[str, ...] = (),
    *,
    keep: tuple[str, ...] = (),
    parse_mode: str = "lazy",
    on_bad: str = "null",
    observation: Observation | None = None,
) -> DataFrame:
    """Rows of ``schema`` from a frame with one text line per row.

    The line is the column of :func:`read_lines`, or ``value`` as Spark's own
    text reader calls it.
    ``columns`` picks and orders the data columns (all if empty); ``keep``
    passes other columns of ``lines`` through behind them. A field past the
    end of a short line is null, surplus fields are ignored. Splitting stops
    at the last wanted field. Both parse modes give the same values; the name
    is checked and otherwise left to the caller's habits.

    ``observation`` collects, in the same pass, ``rows``, and per column
    ``<name>_nulls`` and ``<name>_bad`` (text that could not be decoded).
    """
    if parse_mode not in PARSE_MODES:
        raise ValueError(f"parse mode is one of {', '.join(PARSE_MODES)}, not {parse_mode!r}")
    wanted = list(columns) or schema.names
    if not wanted:
        return lines.select(*keep)
    positions = {name: schema.names.index(name) for name in wanted}
    last = max(positions.values())
    limit = last + 2 if last + 1 < len(schema.names) else -1
    kept = [F.col(quote_name(name)) for name in keep]
    line = F.col(LINE if LINE in lines.columns else "value")
    split = lines.select(split_text(line, fmt.separator(0), limit).alias(FIELDS), *kept)
    texts = {name: F.get(F.col(FIELDS), F.lit(i)) for name, i in positions.items()}
    return _decode(split, texts, schema, fmt, kept, on_bad, observation)


def decode_columns(
    stored: DataFrame,
    schema: T.StructType,
    fmt: DelimitedFormat,
    columns: tuple[str, ...] = (),
    *,
    keep: tuple[str, ...] = (),
    on_bad: str = "null",
    observation: Observation | None = None,
) -> DataFrame:
    """Rows of ``schema`` from a columnar frame that holds every column as text.

    The rules and arguments are those of :func:`decode_lines`; only the
    wanted columns are read.
    """
    wanted = list(columns) or schema.names
    kept = [F.col(quote_name(name)) for name in keep]
    texts = {name: F.col(quote_name(name)) for name in wanted}
    return _decode(stored, texts, schema, fmt, kept, on_bad, observation)


def _decode(
    rows: DataFrame,
    texts: dict[str, Column],
    schema: T.StructType,
    fmt: DelimitedFormat,
    kept: list[Column],
    on_bad: str,
    observation: Observation | None,
) -> DataFrame:
    values = [
        checked(text, schema[name].dataType, fmt, name, on_bad).alias(name)
        for name, text in texts.items()
    ]
    if observation is None:
        return rows.select(*values, *kept)
    flags = [
        undecodable(text, schema[name].dataType, fmt).alias(f"{name}{BAD}")
        for name, text in texts.items()
    ]
    metrics = [F.count(F.lit(1)).alias("rows")]
    for name in texts:
        metrics.append(F.count_if(F.col(quote_name(name)).isNull()).alias(f"{name}_nulls"))
        metrics.append(F.count_if(F.col(quote_name(f"{name}{BAD}"))).alias(f"{name}_bad"))
    observed = rows.select(*values, *kept, *flags).observe(observation, *metrics)
    return observed.select(*(F.col(quote_name(name)) for name in texts), *kept)


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    partition_keys: tuple[str, ...] = (),
    *,
    base_path: str | None = None,
    files: str | None = None,
    skip_unreadable: bool = False,
) -> DataFrame:
    """Text lines with the partition keys as string columns.

    Compressed files (gzip, bzip2, deflate) are opened by their extension.
    ``files`` is a glob that file names must match.
    """
    schema = T.StructType(
        [T.StructField(LINE, T.StringType())]
        + [T.StructField(key, T.StringType()) for key in partition_keys]
    )
    reader = spark.read.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    if files is not None:
        reader = reader.option("pathGlobFilter", files)
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return reader.text(path)
