"""Writing to a catalog table or one static partition of it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from functools import partial
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.widening import upgrade_to
from tablegate.operators.catalog import keep_row_count
from tablegate.operators.observe import observe_rows
from tablegate.sinks.bounded import bounded_by_bytes
from tablegate.sinks.checks import (
    check_output,
    claim_partition,
    claimed_partition,
    partition_exists,
    release_partition,
)
from tablegate.sources.partitions import partition_clause
from tablegate.spec import WriteSpec, quote_name, quote_table
from tablegate.workspace import scratch_folder

MAX_RECORDS_PER_FILE = "spark.sql.files.maxRecordsPerFile"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_TAG = "__output"


def write_table(
    df: DataFrame, spec: WriteSpec, *, check: bool = True, observation: Observation | None = None
) -> None:
    """Write the data columns of ``df`` to the table or partition of ``spec``.

    Columns are matched by name and widened; a missing one is null. The
    files are published once, when the whole job commits, and a failed job
    leaves nothing behind. A new partition is claimed in the catalog before
    the job starts, so of several writers of one partition all but one are
    refused; until the commit it is there without rows, and a failed write
    takes it back. With ``check=False`` only the layout is checked and the
    rows are added to what is there. The catalog keeps the row count of a
    partition that was written.
    """
    spark = df.sparkSession
    target, values = check_output(spark, spec, target_is_new=check)
    rows = upgrade_to(df, target.data)
    is_new = check and bool(values) and not spec.replace_partition
    with claimed_partition(spark, spec, values) if is_new else nullcontext():
        _insert(spark, spec, values, rows, observation, claimed=is_new)


def _insert(
    spark: SparkSession,
    spec: WriteSpec,
    values: Mapping[str, str],
    rows: DataFrame,
    observation: Observation | None = None,
    *,
    claimed: bool = False,
) -> None:
    """Write rows of the target's schema to a target that was checked; a claimed partition has none before."""
    if spec.num_files is not None:
        rows = rows.repartition(spec.num_files)
    if spec.max_bytes_per_file is not None:
        rows = bounded_by_bytes(rows, spec.max_bytes_per_file)
    if observation is not None:
        rows = observe_rows(rows, observation)
    written = Observation()
    if values:
        rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    if values and (claimed or spec.replace_partition):
        _swap_partition(spark, spec, values, rows)
        if not claimed and not written.get["rows"]:
            _empty_partition(spark, spec, values, rows.schema)
    else:
        # {} marks a parameter of the statement, so braces of names and values are doubled
        target_text = f"{quote_table(spec.table)} {partition_clause(values) if values else ''}"
        with _setting(spark, MAX_RECORDS_PER_FILE, spec.max_records_per_file):
            spark.sql(f"INSERT INTO {_literal(target_text)} SELECT * FROM {{rows}}", rows=rows)
    if values:
        keep_row_count(spark, spec.table, values, written.get["rows"], added=not (claimed or spec.replace_partition))


def _swap_partition(spark: SparkSession, spec: WriteSpec, values: Mapping[str, str], rows: DataFrame) -> None:
    """Move new files into one partition when the job commits; until then, and if it fails, the old rows stay.

    Static overwriting deletes before it writes. Dynamic overwriting moves the
    new files in at commit, but leaves a partition alone that gets no row. It
    works in a folder of the job's own, so writers of several partitions of
    one table do not meet; plain inserts share one under the table.
    """
    keyed = rows.select("*", *(F.lit(value).alias(key) for key, value in values.items()))
    names = {key.lower(): key for key in keyed.columns}
    order = [names[c.lower()] for c in spark.table(quote_table(spec.table)).columns]
    with _setting(spark, MAX_RECORDS_PER_FILE, spec.max_records_per_file), _dynamic_overwrite(spark):
        keyed.select(*(quote_name(c) for c in order)).write.mode("overwrite").insertInto(spec.table)


def _empty_partition(
    spark: SparkSession, spec: WriteSpec, values: Mapping[str, str], schema: T.StructType
) -> None:
    """Empty a partition that gets no row, once nothing is left to fail."""
    target = _literal(f"{quote_table(spec.table)} {partition_clause(values)}")
    empty = spark.createDataFrame([], schema)
    spark.sql(f"INSERT OVERWRITE {target} SELECT * FROM {{rows}}", rows=empty)


_DYNAMIC: dict[str, list] = {}
_DYNAMIC_LOCK = Lock()


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite by partition, for as long as any write of this session needs it.

    Were the first of two writes to put the setting back, the second would
    replace the whole table.
    """
    session = spark._jsparkSession.sessionUUID()
    with _DYNAMIC_LOCK:
        held = _DYNAMIC.setdefault(session, [0, spark.conf.get(OVERWRITE_MODE)])
        held[0] += 1
        spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        with _DYNAMIC_LOCK:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(OVERWRITE_MODE, held[1])
                del _DYNAMIC[session]


def _literal(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")


@contextmanager
def _setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A session setting for one write, put back whatever happens; None leaves it alone.

    Writes of one session that run side by side share its settings: give
    each a session of its own if their bounds or modes differ.
    """
    if value is None:
        yield
        return
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_profiles(
    spark: SparkSession, outputs: Mapping[str, tuple[DataFrame, WriteSpec]], *, check: bool = True
) -> None:
    """Several outputs, by name, published all or not at all.

    All checks pass and all new partitions are claimed before the first write
    starts. If a write fails, the outputs written before it are taken back:
    new partitions are dropped, tables that were empty are emptied. What
    cannot be taken back, replaced partitions and rows added to others, is
    written last, so one such output does not weaken the promise.
    Outputs that share a parent are better written by :func:`write_outputs`.
    """
    _publish(spark, [(df, spec) for df, spec in outputs.values()], check)


@dataclass(frozen=True)
class Output:
    """One of several outputs of the same rows: where they go, which columns (all if none), which rows (all if none)."""

    spec: WriteSpec
    columns: tuple[Column | str, ...] = ()
    where: Column | str | None = None


def write_outputs(df: DataFrame, outputs: Mapping[str, Output], *, check: bool = True) -> None:
    """Several outputs of one parent, by name, from one pass over it and published all or not at all.

    Each row is tagged with the outputs that take it and written once for each
    to the shared folder, as the columns of that output. Only when the whole
    pass has ended are the targets touched, as plain copies of what is there,
    under the rules of :func:`write_profiles`. A row that cannot be computed
    thus stops every output before one is changed.
    """
    spark = df.sparkSession
    columns = [[F.col(c) if isinstance(c, str) else c for c in out.columns or map(quote_name, df.columns)] for out in outputs.values()]
    for out, chosen in zip(outputs.values(), columns, strict=True):
        target, _ = check_output(spark, out.spec, target_is_new=check)
        upgrade_to(df.select(*chosen), target.data)
    takes = [
        F.lit(True) if out.where is None else F.expr(out.where) if isinstance(out.where, str) else out.where
        for out in outputs.values()
    ]
    tags = F.array_compact(F.array(*(F.when(take, F.lit(i)) for i, take in enumerate(takes))))
    tagged = df.withColumn(_TAG, F.explode(tags))
    fields = [F.when(F.col(_TAG) == i, F.struct(*chosen)).alias(f"o{i}") for i, chosen in enumerate(columns)]
    folder = scratch_folder(spark)
    with _setting(spark, OPEN_FILES, len(outputs)):
        tagged.select(_TAG, *fields).write.partitionBy(_TAG).parquet(folder)
    staged = spark.read.schema(tagged.select(*fields, _TAG).schema).parquet(folder)
    parts = [staged.where(F.col(_TAG) == i).select(f"o{i}.*") for i in range(len(outputs))]
    _publish(spark, [(rows, out.spec) for rows, out in zip(parts, outputs.values(), strict=True)], check)


def _publish(spark: SparkSession, outputs: Sequence[tuple[DataFrame, WriteSpec]], check: bool) -> None:
    checked = [(df, spec, *check_output(spark, spec, target_is_new=check)) for df, spec in outputs]
    ready = [(upgrade_to(df, target.data), spec, values) for df, spec, target, values in checked]
    undo: dict[tuple, Callable[[], None]] = {}
    try:
        for rows, spec, values in ready:
            key = _target(spec, values)
            if key in undo or spec.replace_partition and values:
                continue
            if values and (check or not partition_exists(spark, spec, values)):
                claim_partition(spark, spec, values)
                undo[key] = partial(release_partition, spark, spec, values)
            elif not values and spark.table(spec.table).isEmpty():
                undo[key] = partial(_empty, spark, spec, rows.schema)
        seen: set[tuple] = set()
        for rows, spec, values in sorted(ready, key=lambda out: _target(*out[1:]) not in undo):
            key = _target(spec, values)
            _insert(spark, spec, values, rows, claimed=key in undo and key not in seen)
            seen.add(key)
    except BaseException:
        for take_back in reversed(undo.values()):
            take_back()
        raise


def _target(spec: WriteSpec, values: Mapping[str, str]) -> tuple:
    return (spec.table.lower(), *sorted(values.items()))


def _empty(spark: SparkSession, spec: WriteSpec, schema: T.StructType) -> None:
    none = spark.createDataFrame([], schema)
    spark.sql(f"INSERT OVERWRITE {_literal(quote_table(spec.table))} SELECT * FROM {{rows}}", rows=none)


def new_rows(spark: SparkSession, schema: T.StructType, rows: list = ()) -> DataFrame:
    """Rows built in code, for a table's data columns."""
    return spark.createDataFrame(list(rows), schema)
