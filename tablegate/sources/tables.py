"""Reading tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.text import unescape_path_value
from tablegate.operators.observe import observe_rows
from tablegate.operators.schema import TableSchema, UnknownColumnError, table_schema
from tablegate.session import tune_session
from tablegate.sources.delimited import decode_columns, decode_lines, read_lines
from tablegate.sources.partitions import NULL_PARTITION, check_partition_filter, list_partitions
from tablegate.spec import DelimitedFormat, ReadSpec, quote_name


MOST_BYTES = 1 << 62  # of a split: the number of splits alone decides


def read_table(
    spark: SparkSession, spec: ReadSpec, observation: Observation | None = None
) -> DataFrame:
    """Rows of all selected partitions.

    Columns come in the order asked for (all data columns if none are named).
    Partition keys follow as strings, unless the caller named some of them.
    The filter picks partitions before a file is opened; a table without
    partition keys ignores it. ``observation`` collects row and null counts,
    and undecodable values for delimited text, while the rows go by.
    """
    if spec.num_splits is not None:
        spark = session_with_splits(spark, spec.num_splits)
    schema, scan = open_table(spark, spec)
    rows = choose_partitions(spark, scan, schema, spec.partition_filter)
    if spec.num_splits is not None:
        # cutting file by file leaves a few splits more; this puts neighbours together, without a shuffle
        rows = rows.coalesce(spec.num_splits)
    data, keys = output_columns(schema, spec.columns)
    wanted = wanted_order(spec, data, keys)
    if spec.format == "delimited" or spec.text_columns:
        # with only partition keys asked for, some column still has to carry the rows
        decoded = tuple(data) or tuple(schema.data.names[:1])
        if spec.text_columns:
            rows = decode_columns(
                rows, schema.data, spec.delimited, decoded,
                keep=schema.partition_keys, on_bad=spec.on_bad, observation=observation,
            )
        else:
            rows = decode_lines(
                rows, schema.data, spec.delimited, decoded, keep=schema.partition_keys,
                parse_mode=spec.parse_mode, on_bad=spec.on_bad, observation=observation,
            )
        return rows.select(*(F.col(quote_name(name)) for name in wanted))
    rows = rows.select(
        *(
            rows[quote_name(name)].cast("string").alias(name)
            if name in schema.partition_keys
            else rows[quote_name(name)]
            for name in wanted
        )
    )
    return observe_rows(rows, observation) if observation is not None else rows


def open_table(spark: SparkSession, spec: ReadSpec) -> tuple[TableSchema, DataFrame]:
    """Schema and scan of a table or path, not yet filtered or decoded."""
    if spec.format == "delimited":
        schema = table_schema(spark, spec)
        return schema, read_lines(
            spark, spec.path, schema.partition_keys, skip_unreadable=spec.skip_unreadable
        )
    reader = spark.read
    if spec.skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    if spec.table is not None:
        return table_schema(spark, spec), reader.table(spec.table)
    reader = reader.format(spec.format)
    if spec.schema is None:
        found = reader.load(spec.path)
        if not spec.partition_keys:
            return TableSchema(found.schema), found
        spec = replace(
            spec,
            schema=T.StructType([f for f in found.schema if f.name not in spec.partition_keys]),
        )
    schema = table_schema(spark, spec)
    stored = schema.struct
    if spec.text_columns:
        stored = T.StructType([T.StructField(name, T.StringType()) for name in schema.names])
    # an explicit schema keeps 007 a string and fills columns old files lack with null
    return schema, reader.schema(stored).load(spec.path)


def output_columns(schema: TableSchema, columns: Iterable[str]) -> tuple[list[str], list[str]]:
    """Data columns and partition keys a read returns."""
    columns = list(columns)
    if not columns:
        return list(schema.data.names), list(schema.partition_keys)
    for name in columns:
        if name not in schema.names:
            raise UnknownColumnError(f"no column {name!r}; columns: {', '.join(schema.names)}")
    data = [name for name in columns if name not in schema.partition_keys]
    named_keys = [name for name in columns if name in schema.partition_keys]
    return data, named_keys or list(schema.partition_keys)


def wanted_order(spec: ReadSpec, data: list[str], keys: list[str]) -> list[str]:
    if any(name in keys for name in spec.columns):
        return list(spec.columns)
    return data + keys


def choose_partitions(
    spark: SparkSession, rows: DataFrame, schema: TableSchema, predicate: str | None
) -> DataFrame:
    """Apply a partition predicate, checked to touch partition keys only.

    Keys are compared as strings, whatever type the catalog gives them, so a
    read, a listing and statistics choose alike; the cast key still prunes.
    """
    if not predicate or not schema.partition_keys:
        return rows
    check_partition_filter(spark, schema.partition_keys, predicate)
    typed = [f.name for f in rows.schema if f.name in schema.partition_keys and not isinstance(f.dataType, T.StringType)]
    texts = {key: F.col(quote_name(key)).cast("string") for key in typed}
    return (rows.withColumns(texts) if texts else rows).where(predicate)


def session_with_splits(spark: SparkSession, num_splits: int) -> SparkSession:
    """Session of the same application whose scans aim at ``num_splits`` input splits.

    The scan divides the bytes of the files it chose by that number, and no
    other bound applies, so there can be fewer splits than by default as well
    as more. Small files are put together up to that size. A file that cannot
    be cut stays whole, and a split without a row group's middle has no rows.
    These are session settings, and this keeps them away from the caller's
    session. No rows are shuffled to reach the count.
    """
    if num_splits < 1:
        raise ValueError("num_splits is at least 1")
    other = spark.newSession()
    # a new session starts in the default database; a bare name must mean the same table in both
    other.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    other.conf.set("spark.sql.files.minPartitionNum", str(num_splits))
    other.conf.set("spark.sql.files.openCostInBytes", "1")
    other.conf.set("spark.sql.files.maxPartitionBytes", str(MOST_BYTES))
    return tune_session(other)


def read_profiles(spark: SparkSession, specs: Mapping[str, ReadSpec]) -> dict[str, DataFrame]:
    """Several inputs for one job, by name."""
    return {name: read_table(spark, spec) for name, spec in specs.items()}


@dataclass(frozen=True)
class FormatGroup:
    """The partitions of one table that share a storage format.

    ``paths`` are partition directories under the table's base path.
    """

    format: str
    paths: tuple[str, ...]
    schema: T.StructType
    delimited: DelimitedFormat | None = None


def check_covered(
    spark: SparkSession,
    base_path: str,
    groups: Iterable[FormatGroup],
    keys: tuple[str, ...],
    partition_filter: str | None = None,
) -> None:
    """Raise if a selected partition under ``base_path`` belongs to no group."""
    if not keys:
        return
    folders = [path.rstrip("/").split("/")[-len(keys) :] for group in groups for path in group.paths]
    texts = T.StructType([T.StructField(f"__{i}", T.StringType()) for i in range(len(keys))])
    named = spark.createDataFrame([[f.partition("=")[2] for f in folder] for folder in folders], texts)
    named = named.select(
        *(F.nullif(unescape_path_value(F.col(name)), F.lit(NULL_PARTITION)).alias(name) for name in texts.names)
    )
    found = list_partitions(
        spark, ReadSpec(path=base_path, schema=T.StructType(), partition_keys=keys, partition_filter=partition_filter)
    )
    same = [found[quote_name(key)].eqNullSafe(named[name]) for key, name in zip(keys, texts.names, strict=True)]
    left_out = found.join(named, same, "left_anti").first()
    if left_out is not None:
        raise ValueError(f"no format is given for partition {left_out.asDict()} of {base_path}")


def read_mixed_formats(
    spark: SparkSession, base_path: str, groups: Iterable[FormatGroup], spec: ReadSpec
) -> DataFrame:
    """A table whose partitions are stored in different formats.

    One scan per format, not per partition; ``spec`` gives the table's schema,
    keys, columns and filter. Columns a group does not have are null. A
    partition with files that no group names is an error, not left out.
    """
    schema = table_schema(spark, replace(spec, path=base_path, table=None))
    groups = list(groups)
    check_covered(spark, base_path, groups, schema.partition_keys, spec.partition_filter)
    data, keys = output_columns(schema, spec.columns)
    scans = []
    for group in groups:
        if group.format == "delimited":
            lines = read_lines(
                spark, list(group.paths), schema.partition_keys,
                base_path=base_path, skip_unreadable=spec.skip_unreadable,
            )
            stored = tuple(n for n in data if n in group.schema.names)
            rows = decode_lines(
                lines, group.schema, group.delimited or spec.delimited,
                stored or tuple(group.schema.names[:1]), keep=schema.partition_keys,
                parse_mode=spec.parse_mode, on_bad=spec.on_bad,
            )
        else:
            full = TableSchema(group.schema, schema.partition_keys).struct
            reader = spark.read.format(group.format).schema(full).option("basePath", base_path)
            if spec.skip_unreadable:
                reader = reader.option("ignoreCorruptFiles", True)
                reader = reader.option("ignoreMissingFiles", True)
            rows = reader.load(list(group.paths))
        scans.append(
            rows.select(
                *(
                    rows[quote_name(f.name)].cast(f.dataType).alias(f.name)
                    if f.name in rows.columns
                    else F.lit(None).cast(f.dataType).alias(f.name)
                    for f in schema.struct.fields
                    if f.name in data or f.name in schema.partition_keys
                )
            )
        )
    rows = reduce(lambda a, b: a.unionByName(b), scans)
    rows = choose_partitions(spark, rows, schema, spec.partition_filter)
    return rows.select(*(F.col(quote_name(name)) for name in wanted_order(spec, data, keys)))
