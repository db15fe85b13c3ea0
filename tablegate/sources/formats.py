"""Tables whose files are stored in several formats, told apart by what the files are called and where they lie."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.schema import TableSchema, table_schema
from tablegate.sources.delimited import decode_lines, read_lines
from tablegate.sources.partitions import check_partition_filter, list_files
from tablegate.sources.tables import choose_partitions, output_columns, wanted_order
from tablegate.spec import DelimitedFormat, ReadSpec, quote_name


@dataclass(frozen=True)
class FormatRule:
    """Files of one format: a glob over file names, a predicate over partition keys, or both.

    ``schema`` holds the data columns of these files, the table's if left out.
    """

    format: str
    files: str = "*"
    where: str | None = None
    schema: T.StructType | None = None
    delimited: DelimitedFormat | None = None


BY_NAME = (
    FormatRule("parquet", "*.parquet"),
    FormatRule("orc", "*.orc"),
    FormatRule("json", "*.json{,.gz,.bz2,.deflate,.zst,.lz4,.snappy}"),
    FormatRule("delimited", "*.{txt,csv,tsv}{,.gz,.bz2,.deflate,.zst,.lz4,.snappy}"),
)


class UnknownFormatError(ValueError):
    """A selected file that no rule, or more than one, claims."""


def glob_pattern(glob: str) -> str:
    """Regular expression of a file name glob (``*``, ``?``, ``[..]``, ``{a,b}``)."""
    out, depth, at = [], 0, 0
    while at < len(glob):
        c = glob[at]
        if c == "[" and "]" in glob[at + 2 :]:
            end = glob.index("]", at + 2)
            inside = glob[at + 1 : end].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out.append(f"[{'^' + inside[1:] if inside[0] in '!^' else inside}]")
            at = end
        elif c == "{":
            out.append("(?:")
            depth += 1
        elif c == "}" and depth:
            out.append(")")
            depth -= 1
        elif c == "," and depth:
            out.append("|")
        else:
            out.append({"*": ".*", "?": "."}.get(c) or re.escape(c))
        at += 1
    return f"^{''.join(out)}\\z"


def files_by_rule(spark: SparkSession, spec: ReadSpec, rules: Sequence[FormatRule]) -> DataFrame:
    """Every selected file of a path with the numbers of the ``rules`` that claim it; files stay closed."""
    keys = table_schema(spark, spec).partition_keys
    files = list_files(spark, spec.path, keys)
    if spec.partition_filter and keys:
        check_partition_filter(spark, keys, spec.partition_filter)
        files = files.where(spec.partition_filter)
    name = F.substring_index("file_path", "/", -1)
    claims = F.array(*(F.when(_claims(spark, keys, rule, name), F.lit(at)) for at, rule in enumerate(rules)))
    return files.withColumn("rules", F.array_compact(claims))


def _claims(spark: SparkSession, keys: Sequence[str], rule: FormatRule, name: Column) -> Column:
    named = name.rlike(glob_pattern(rule.files))
    if rule.where is None:
        return named
    check_partition_filter(spark, keys, rule.where)
    return named & F.coalesce(F.expr(rule.where), F.lit(False))


def rules_in_use(spark: SparkSession, spec: ReadSpec, rules: Sequence[FormatRule]) -> list[int]:
    """Numbers of the rules that claim a selected file, from one listing; to the driver comes one row.

    A file that no rule claims, or several do, is an error: it would be left
    out or read twice.
    """
    files = files_by_rule(spark, spec, rules)
    found = files.agg(
        F.min(F.when(F.size("rules") == 0, F.col("file_path"))).alias("nobody"),
        F.min(F.when(F.size("rules") > 1, F.col("file_path"))).alias("several"),
        *(F.count_if(F.array_contains("rules", at)).alias(f"n{at}") for at in range(len(rules))),
    ).first()
    if found["nobody"] is not None:
        raise UnknownFormatError(f"no format rule is given for {found['nobody']}")
    if found["several"] is not None:
        raise UnknownFormatError(f"more than one format rule claims {found['several']}")
    return [at for at in range(len(rules)) if found[f"n{at}"]]


def read_by_format(spark: SparkSession, spec: ReadSpec, rules: Sequence[FormatRule] = BY_NAME) -> DataFrame:
    """Rows of a path whose files are in different formats, none of them named by the caller.

    The path is listed once to see which formats there are and that every
    selected file has exactly one; then each format is one scan of the whole
    path, narrowed to its files by name and by partition when it is planned.
    Neither folders nor files pass through the driver's hands, so the number
    of partitions does not matter here. Columns that files of a format do not
    have are null; the other rules are those of :func:`read_table`.
    """
    if spec.path is None:
        raise ValueError("formats are told apart by files, so a path is needed")
    schema = table_schema(spark, spec)
    data, keys = output_columns(schema, spec.columns)
    used = rules_in_use(spark, spec, rules) or [0]
    scans = [conform(_scan(spark, spec, rules[at], schema, data), schema, data) for at in used]
    rows = reduce(DataFrame.unionByName, scans)
    return rows.select(*(F.col(quote_name(name)) for name in wanted_order(spec, data, keys)))


def _scan(spark: SparkSession, spec: ReadSpec, rule: FormatRule, schema: TableSchema, data: list[str]) -> DataFrame:
    """The files of one rule in the selected partitions, decoded."""
    stored = rule.schema or schema.data
    if rule.format == "delimited":
        rows = read_lines(
            spark, spec.path, schema.partition_keys, files=rule.files, skip_unreadable=spec.skip_unreadable
        )
    else:
        reader = spark.read.format(rule.format).schema(TableSchema(stored, schema.partition_keys).struct)
        reader = reader.option("pathGlobFilter", rule.files)
        if spec.skip_unreadable:
            reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
        rows = reader.load(spec.path)
    rows = choose_partitions(spark, rows, schema, spec.partition_filter)
    if rule.where is not None:
        rows = rows.where(rule.where)
    if rule.format != "delimited":
        return rows
    wanted = tuple(name for name in data if name in stored.names) or tuple(stored.names[:1])
    return decode_lines(
        rows, stored, rule.delimited or spec.delimited, wanted, keep=schema.partition_keys,
        parse_mode=spec.parse_mode, on_bad=spec.on_bad,
    )


def conform(rows: DataFrame, schema: TableSchema, data: Sequence[str]) -> DataFrame:
    """Wanted data columns and all keys in the table's types; null where ``rows`` has no such column."""
    return rows.select(
        *(
            rows[quote_name(f.name)].cast(f.dataType).alias(f.name)
            if f.name in rows.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.struct.fields
            if f.name in data or f.name in schema.partition_keys
        )
    )

