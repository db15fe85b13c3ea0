"""Partitions of a table and the predicates that choose among them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.text import NULL_PARTITION, unescape_path_value
from tablegate.operators.schema import table_schema
from tablegate.spec import ReadSpec, quote_name, quote_string, quote_table


def check_partition_filter(spark: SparkSession, keys: Iterable[str], predicate: str) -> None:
    """Resolve the predicate on the partition keys alone.

    A data column in it fails here, before any file is listed. Keys are
    strings, so literals are quoted: ``ds = '2'``.
    """
    keys_only = T.StructType([T.StructField(key, T.StringType()) for key in keys])
    chosen = spark.createDataFrame([], keys_only).where(predicate)
    if not chosen._jdf.queryExecution().analyzed().deterministic():
        raise ValueError(f"a partition filter gives one answer per partition: {predicate}")


def list_partitions(spark: SparkSession, spec: ReadSpec) -> DataFrame:
    """One row per partition that passes the filter, one string column per key.

    A catalog table answers from the catalog. A path is listed as files
    without opening any of them.
    """
    keys = table_schema(spark, spec).partition_keys
    if not keys:
        raise ValueError("the table has no partition keys")
    if spec.table is not None:
        shown = spark.sql(f"SHOW PARTITIONS {quote_table(spec.table)}")
        parts = F.split("partition", "/")
        values = [
            unescape_path_value(F.substring_index(parts[i], "=", -1)).alias(key)
            for i, key in enumerate(keys)
        ]
        partitions = shown.select(
            *(
                F.nullif(value, F.lit(NULL_PARTITION)).alias(key)
                for value, key in zip(values, keys, strict=True)
            )
        )
    else:
        partitions = list_files(spark, spec.path, keys).select(*map(quote_name, keys)).distinct()
    if spec.partition_filter:
        check_partition_filter(spark, keys, spec.partition_filter)
        partitions = partitions.where(spec.partition_filter)
    return partitions


def list_files(spark: SparkSession, path: str, keys: Iterable[str] = (), *, uri: bool = False) -> DataFrame:
    """One row per file under ``path``: partition keys, ``file_path``, ``file_size``.

    With ``uri`` there is ``file_uri`` too, the name that rows read from the
    file have for it.

    The content column is not selected, so the files stay closed. The scan is
    cut by file size as if they were read; coalescing gives each task many
    files to name instead of one.
    """
    schema = T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("modificationTime", T.TimestampType()),
            T.StructField("length", T.LongType()),
            T.StructField("content", T.BinaryType()),
            *(T.StructField(key, T.StringType()) for key in keys),
        ]
    )
    files = spark.read.format("binaryFile").schema(schema).load(path)
    return files.coalesce(spark.sparkContext.defaultParallelism).select(
        *map(quote_name, keys), F.col("path").alias("file_path"), F.col("length").alias("file_size"),
        *([F.col("_metadata.file_path").alias("file_uri")] if uri else []),
    )


def match_partition_spec(keys: Iterable[str], given: Mapping[str, str]) -> dict[str, str]:
    """``given`` values in table key order; names match in any letter case."""
    by_lower = {name.lower(): value for name, value in given.items()}
    keys = list(keys)
    missing = [key for key in keys if key.lower() not in by_lower]
    unknown = sorted(set(by_lower) - {key.lower() for key in keys})
    if missing or unknown or len(by_lower) != len(given):
        raise ValueError(
            f"partition keys are {keys}, values were given for {sorted(given)}"
        )
    return {key: by_lower[key.lower()] for key in keys}


def partition_clause(values: Mapping[str, str]) -> str:
    """``PARTITION (k = 'v', ...)``. Values are quoted: bare ``007`` would become ``7``."""
    for key, value in values.items():
        if not isinstance(value, str) or value == "":
            raise ValueError(f"partition key {key}: the value must be a non-empty string")
    pairs = (f"{quote_name(key)} = {quote_string(value)}" for key, value in values.items())
    return f"PARTITION ({', '.join(pairs)})"
