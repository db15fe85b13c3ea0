"""Output files bounded by the bytes of their rows, whatever the widths of the rows."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.spec import quote_name
from tablegate.workspace import scratch_folder

WIDE_SHARE = 8  # a row above this part of the bound has a file of its own
_FIXED = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row before encoding and compression.

    Numbers and dates take their width, null or not, texts and binaries their
    bytes and a length of four. Lists, maps and structs count as their JSON.
    """
    return reduce(add, (_bytes(field) for field in schema.fields), F.lit(0).cast("long"))


def _bytes(field: T.StructField) -> Column:
    column, kind = F.col(quote_name(field.name)), type(field.dataType)
    if issubclass(kind, T.StringType | T.BinaryType | T.VarcharType | T.CharType):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + 4
    if issubclass(kind, T.ArrayType | T.MapType | T.StructType):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)).cast("long") + 4
    if issubclass(kind, T.DecimalType):
        return F.lit(16).cast("long")
    return F.lit(_FIXED.get(kind, 8)).cast("long")


def bounded_by_bytes(rows: DataFrame, most: int) -> DataFrame:
    """The rows, dealt so that a task that writes one file writes at most ``most`` bytes of rows.

    Bytes are those of ``row_bytes``; the encoding makes files smaller, footers
    come on top. Rows are first staged in the shared folder, so their order
    stays the same when an executor is lost. Each staged file is then cut where
    its running sum passes a step that leaves room for one more row; a row
    above an eighth of the bound has a task of its own, and one above the bound
    alone exceeds it. Every staged file leaves one part that is not full. One
    window task reads one staged file, whatever the keys. One row per staged
    file comes to the driver, and each output file is one reduce task.
    """
    if most < 1:
        raise ValueError(f"at least one byte per file, not {most}")
    spark, path = rows.sparkSession, scratch_folder(rows.sparkSession)
    # places in place of names: columns of the caller may have any name
    names, places = rows.columns, [f"c{i}" for i in range(len(rows.columns))]
    rows.withColumn("__bytes", row_bytes(rows.schema)).toDF(*places, "bytes").write.parquet(path)
    staged = spark.read.parquet(path).select(
        *places, "bytes", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    wide = F.col("bytes") > most // WIDE_SHARE
    step = most - most // WIDE_SHARE
    narrow = F.when(wide, 0).otherwise(F.col("bytes"))
    files = (
        staged.groupBy("file")
        .agg((F.floor(F.sum(narrow) / step) + 1).cast("long").alias("parts"), F.count_if(wide).alias("wide"))
        .orderBy("file")
        .collect()
    )
    if not files:
        return rows
    first, firsts = 0, []
    for row in files:
        firsts.append((row["file"], first, first + row["parts"]))
        first += row["parts"] + row["wide"]
    starts = spark.createDataFrame(firsts, "file string, first_narrow long, first_wide long")
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    numbered = staged.withColumns(
        {
            "sum": F.coalesce(F.sum(narrow).over(before), F.lit(0)),
            "count": F.coalesce(F.count_if(wide).over(before), F.lit(0)),
        }
    )
    # one row per staged file, so as small as the list of a task's inputs
    placed = numbered.join(F.broadcast(starts), "file").withColumn(
        "part",
        F.when(wide, F.col("first_wide") + F.col("count")).otherwise(
            F.col("first_narrow") + F.floor(F.col("sum") / step)
        ),
    )
    dealt = placed.repartitionById(first, F.col("part").cast("int"))
    return dealt.select(*(F.col(place).alias(name) for place, name in zip(places, names, strict=True)))
