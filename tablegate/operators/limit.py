"""Exact row limit, in one of two forms that the caller names."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_BITS = 33
FILE, ROW_INDEX = "_metadata.file_path", "_metadata.row_index"


def limit_rows(df: DataFrame, count: int, in_place: bool = False) -> DataFrame:
    """Any ``count`` rows of ``df`` (all if it has fewer).

    By default this is Spark's limit, for counts that one task can hold: a
    last step stops the scan early, but with steps after it up to ``count``
    rows of every partition come together in one task.

    ``in_place=True`` is for any larger count. Rows are counted when this is
    called, over growing groups of the scan's files, until they are enough;
    later files are not read. Files that number their rows (Parquet) are
    counted from their footers, up to conditions on columns, and the rows of
    the first files are then read once: whole files, and of the last one the
    rows up to a number. Of other files the chosen ones are counted, then
    counted by partition, then read, and must be cut alike each time. ``df``
    is a scan with narrow steps on top, over files that do not change in
    between. A frame that reads no files is counted whole.
    """
    if count < 0:
        raise ValueError("a row limit is not negative")
    if not in_place:
        return df.limit(count)
    if count == 0:
        return df.where(F.lit(False))
    try:
        df.select(ROW_INDEX)
    except AnalysisException:
        return _first_rows(_enough_files(df, count), count)
    return _numbered_rows(df, count)


def _groups(df: DataFrame) -> Iterator[tuple[Column, bool]]:
    """Conditions that choose the files of ``df`` by path, group after group; whether it is the last.

    Groups start at one file per core and double what was taken before. A
    range of paths prunes files when the scan lists them. Ranges that fit the
    files badly cost time only, since the same ranges are counted and kept.
    """
    # rows name their file without the empty host of a listed one
    files = sorted(re.sub("^([a-z]+):///", r"\1:/", name) for name in df.inputFiles())
    path = F.col(FILE)
    taken = 0
    while taken < len(files):
        upper = min(len(files), max(2 * taken, df.sparkSession.sparkContext.defaultParallelism))
        last = upper == len(files)
        low = path > files[taken - 1] if taken else F.lit(True)
        yield (low if last else low & (path <= files[upper - 1])), last
        taken = upper


def _numbered_rows(df: DataFrame, count: int) -> DataFrame:
    """The first ``count`` rows by file and by number in the file."""
    before = 0
    for group, _ in _groups(df):
        per_file = df.where(group).groupBy(F.col(FILE).alias("file")).agg(
            F.count(F.lit(1)).alias("rows"), F.max(ROW_INDEX).alias("last")
        )
        # one row per file of the group
        running = per_file.withColumn("upto", F.sum("rows").over(Window.orderBy("file")))
        found = running.agg(
            F.coalesce(F.max("upto"), F.lit(0)).alias("rows"),
            F.min(F.when(F.col("upto") >= count - before, F.struct("upto", "file", "rows", "last"))).alias("cut"),
        ).first()
        if found["cut"] is None:
            before += found["rows"]
            continue
        cut = found["cut"]
        inside = count - before - (cut["upto"] - cut["rows"])
        number = inside - 1
        if cut["last"] + 1 != cut["rows"]:
            # some rows of the file were left out: the number of the last one wanted
            numbers = df.where(F.col(FILE) == cut["file"]).select(F.col(ROW_INDEX).alias("n"))
            number = numbers.sort("n").limit(inside).agg(F.max("n")).first()[0]
        # the first condition alone keeps later files closed
        first = df.where(F.col(FILE) <= cut["file"])
        return first.where((F.col(FILE) < cut["file"]) | (F.col(ROW_INDEX) <= number))
    return df


def _enough_files(df: DataFrame, count: int) -> DataFrame:
    """``df`` over its first files by path, so many that they hold ``count`` rows (all if fewer)."""
    rows, kept = 0, F.lit(False)
    for group, last in _groups(df):
        kept = kept | group
        rows += df.where(group).count()
        if rows >= count and not last:
            return df.where(kept)
    return df


def _first_rows(df: DataFrame, count: int) -> DataFrame:
    # one row per partition: the number of tasks bounds what comes together here
    per_partition = df.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    running = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        per_partition.select(
            "part", "rows", F.coalesce(F.sum("rows").over(running), F.lit(0)).alias("before")
        )
        .where((F.col("before") < count) & (F.col("before") + F.col("rows") >= count))
        .first()
    )
    if cut is None:
        return df
    numbered = df.withColumns(
        {
            "__part": F.spark_partition_id(),
            # the low bits of this id number the rows of a partition
            "__row": F.monotonically_increasing_id().bitwiseAND(2**ROW_BITS - 1),
        }
    )
    kept = (F.col("__part") < cut.part) | (
        (F.col("__part") == cut.part) & (F.col("__row") < count - cut.before)
    )
    return numbered.where(kept).drop("__part", "__row")
