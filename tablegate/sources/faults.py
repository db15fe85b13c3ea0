"""What a read could not use: rows with malformed values, files that gave no rows or not all."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.functions.decode import decode, split_text, undecodable
from tablegate.operators.observe import drain
from tablegate.operators.schema import TableSchema
from tablegate.sources.delimited import LINE
from tablegate.sources.partitions import list_files
from tablegate.sources.tables import choose_partitions, open_table, output_columns
from tablegate.spec import ReadSpec, quote_name
from tablegate.workspace import scratch_folder

FILE = "_metadata.file_path"
FAULTS = "array<struct<column:string,type:string,text:string>>"


def _texts(rows: DataFrame, spec: ReadSpec, schema: TableSchema, names: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """Rows with their file, their line (null for columnar text) and the text of each named column."""
    keys = [F.col(quote_name(key)) for key in schema.partition_keys]
    if spec.text_columns:
        stored = rows.select(*keys, F.col(FILE).alias("__file"), F.lit(None).cast("string").alias(LINE), *map(quote_name, names))
        return stored, {name: F.col(quote_name(name)) for name in names}
    fields = split_text(F.col(LINE), spec.delimited.separator(0)).alias("__fields")
    split = rows.select(*keys, F.col(FILE).alias("__file"), LINE, fields)
    return split, {name: F.get("__fields", F.lit(schema.data.names.index(name))) for name in names}


def _judged(spark: SparkSession, spec: ReadSpec) -> tuple[DataFrame, dict[str, Column], TableSchema]:
    """Selected rows with ``__faults``, an entry for each malformed value of the wanted columns."""
    if spec.format != "delimited" and not spec.text_columns:
        raise ValueError("only text is decoded; other formats hold no malformed values")
    schema, scan = open_table(spark, spec)
    names = output_columns(schema, spec.columns)[0] or list(schema.data.names)
    rows, texts = _texts(choose_partitions(spark, scan, schema, spec.partition_filter), spec, schema, names)
    found = []
    for name, text in texts.items():
        dtype = schema.data[name].dataType
        fault = F.struct(F.lit(name).alias("column"), F.lit(dtype.simpleString()).alias("type"), text.alias("text"))
        found.append(F.when(undecodable(text, dtype, spec.delimited), fault))
    return rows.withColumn("__faults", F.array_compact(F.array(*found)).cast(FAULTS)), texts, schema


def malformed_rows(spark: SparkSession, spec: ReadSpec) -> DataFrame:
    """The rows in which a wanted column holds text that is no value of its type, as they are in the files.

    Partition keys, ``file``, ``line`` (the whole line; null for columnar
    text) and ``faults``: column, type and text of each malformed value, in
    the order of the columns. One narrow scan.
    """
    rows, _, schema = _judged(spark, spec)
    return _report(rows.where(F.size("__faults") > 0), schema)


def _report(rows: DataFrame, schema: TableSchema) -> DataFrame:
    keys = (F.col(quote_name(key)) for key in schema.partition_keys)
    return rows.select(*keys, F.col("__file").alias("file"), F.col(LINE).alias("line"), F.col("__faults").alias("faults"))


def split_malformed(spark: SparkSession, spec: ReadSpec) -> tuple[DataFrame, DataFrame]:
    """The rows without a malformed value, decoded, and apart from them the others as :func:`malformed_rows` has them.

    Both come from one pass, which writes them to the shared folder; the files
    are not read again, and a row is in exactly one of the two.
    """
    judged, texts, schema = _judged(spark, spec)
    bad = F.size("__faults") > 0
    # the data columns in a struct of their own, so that no name clashes
    values = F.struct(*(decode(t, schema.data[n].dataType, spec.delimited).alias(n) for n, t in texts.items()))
    keys = [F.col(quote_name(key)) for key in schema.partition_keys]
    aside = F.struct(F.col("__file").alias("file"), F.col(LINE).alias("line"), F.col("__faults").alias("faults"))
    rows = judged.select(
        F.struct(*keys, F.lit(True).alias("__")).alias("keys"), F.when(~bad, values).alias("values"),
        F.when(bad, aside).alias("aside"), bad.alias("bad"),
    )
    folder = scratch_folder(spark)
    rows.write.partitionBy("bad").parquet(folder)
    stored = spark.read.schema(rows.schema).parquet(folder)
    key_columns = [F.col(f"keys.{quote_name(key)}").alias(key) for key in schema.partition_keys]
    good = stored.where("NOT bad").select(*(F.col(f"values.{quote_name(n)}").alias(n) for n in texts), *key_columns)
    return good, stored.where("bad").select(*key_columns, "aside.file", "aside.line", "aside.faults")


def skipped_files(spark: SparkSession, spec: ReadSpec) -> DataFrame:
    """The selected files of which a read with ``skip_unreadable`` passes over rows: one row each.

    Partition keys, ``file_path``, ``file_size``, ``rows_read`` and
    ``reason``: ``unreadable`` (no row could be read), ``partial`` (fewer
    rows than the file's own count), or ``empty`` (a sound file without
    rows; files without a byte are not listed). The listing is joined with what a reading of all wanted columns
    gave per file, and with the counts that columnar files state themselves.
    Whether files without a row are sound is found by reading them together
    and halving the set as long as that fails, which takes few jobs for any
    number of sound files and some for each broken one; their names come to
    the driver.
    """
    if spec.path is None:
        raise ValueError("skipped files are told from the listing of a path")
    lenient = replace(spec, skip_unreadable=True)
    schema, scan = open_table(spark, lenient)
    rows = choose_partitions(spark, scan, schema, spec.partition_filter)
    wanted = [LINE] if spec.format == "delimited" else output_columns(schema, spec.columns)[0] or schema.data.names[:1]
    # a hash that is used makes the reader decode the columns
    read = rows.groupBy(F.col(FILE).alias("__read")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*map(quote_name, wanted))).alias("hash")
    )
    read = read.select("__read", F.when(F.col("hash").isNotNull(), F.col("n")).alias("rows_read"))
    stated = rows.groupBy(F.col(FILE).alias("__stated")).agg(F.count(F.lit(1)).alias("rows_stated"))
    files = list_files(spark, spec.path, schema.partition_keys, uri=True)
    if spec.partition_filter and schema.partition_keys:
        files = files.where(spec.partition_filter)
    joined = files.join(read, files["file_uri"] == read["__read"], "left").join(
        stated, files["file_uri"] == stated["__stated"], "left"
    )
    zero = F.lit(0).cast("long")
    counted = joined.withColumns(
        {"rows_read": F.coalesce("rows_read", zero), "rows_stated": F.coalesce("rows_stated", zero)}
    )
    lacking = counted.where((F.col("rows_read") == 0) | (F.col("rows_read") < F.col("rows_stated"))).select(
        *map(quote_name, schema.partition_keys), "file_path", "file_size", "rows_read", "rows_stated"
    )
    folder = scratch_folder(spark)
    lacking.write.parquet(folder)
    lacking = spark.read.schema(lacking.schema).parquet(folder)
    silent = lacking.where("rows_stated = 0 AND file_size > 0").select("file_path").toLocalIterator()
    broken = _unreadable(spark, spec, schema, [row[0] for row in silent])
    names = spark.createDataFrame([(name,) for name in broken], "__broken string")
    marked = lacking.join(names, lacking["file_path"] == names["__broken"], "left")
    reason = (
        F.when((F.col("rows_read") == 0) & (F.col("__broken").isNotNull() | (F.col("rows_stated") > 0)), "unreadable")
        .when(F.col("rows_read") < F.col("rows_stated"), "partial")
        .otherwise("empty")
    )
    return marked.withColumn("reason", reason).drop("__broken", "rows_stated")


def _unreadable(spark: SparkSession, spec: ReadSpec, schema: TableSchema, paths: list[str]) -> list[str]:
    """Those of the files that cannot be read."""
    if not paths:
        return []
    literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in paths]
    reader = spark.read.option("ignoreCorruptFiles", False).option("ignoreMissingFiles", False)
    try:
        drain(reader.text(literal) if spec.format == "delimited" else reader.format(spec.format).schema(schema.data).load(literal))
    except (PySparkException, Py4JJavaError):
        if len(paths) == 1:
            return paths
        half = len(paths) // 2
        return _unreadable(spark, spec, schema, paths[:half]) + _unreadable(spark, spec, schema, paths[half:])
    return []
