"""Table schema: positions, kinds and partition flags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablegate.functions.kinds import kind_or_type_name
from tablegate.spec import ReadSpec, qualified_name

SCHEMA_COLUMNS = "position int, name string, kind string, is_partition boolean"


class UnknownColumnError(KeyError):
    """A name that is neither a data column nor a partition key."""

    def __str__(self) -> str:
        return str(self.args[0])


@dataclass(frozen=True)
class TableSchema:
    """Data columns first, then the partition keys, which are strings."""

    data: T.StructType
    partition_keys: tuple[str, ...] = ()

    @property
    def num_columns(self) -> int:
        return len(self.data.fields)

    @property
    def num_partition_keys(self) -> int:
        return len(self.partition_keys)

    @property
    def names(self) -> tuple[str, ...]:
        return (*self.data.names, *self.partition_keys)

    @property
    def struct(self) -> T.StructType:
        """Whole row: data columns and partition keys."""
        keys = [T.StructField(key, T.StringType()) for key in self.partition_keys]
        return T.StructType([*self.data.fields, *keys])

    def position_of(self, name: str) -> int:
        """Position of a stored name (letter case matters)."""
        if name not in self.names:
            raise UnknownColumnError(f"no column {name!r}; columns: {', '.join(self.names)}")
        return self.names.index(name)

    def column_type(self, position: int) -> T.DataType:
        """Type of a data column."""
        if not 0 <= position < self.num_columns:
            raise IndexError(f"position {position} is not one of {self.num_columns} data columns")
        return self.data.fields[position].dataType

    def column_kind(self, position: int) -> str:
        return kind_or_type_name(self.column_type(position))

    def as_frame(self, spark: SparkSession) -> DataFrame:
        """One row per column: position, name, kind, is_partition."""
        rows = [
            (i, field.name, kind_or_type_name(field.dataType), i >= self.num_columns)
            for i, field in enumerate(self.struct.fields)
        ]
        return spark.createDataFrame(rows, SCHEMA_COLUMNS)


def catalog_schema(spark: SparkSession, table: str) -> TableSchema:
    """Schema of a catalog table."""
    fields = {f.name: f for f in spark.table(table).schema.fields}
    columns = spark.catalog.listColumns(table)
    return TableSchema(
        T.StructType([fields[c.name] for c in columns if not c.isPartition]),
        tuple(c.name for c in columns if c.isPartition),
    )


def table_schema(spark: SparkSession, source: str | ReadSpec) -> TableSchema:
    """Schema of a catalog table, or of what a :class:`ReadSpec` describes."""
    if isinstance(source, str):
        return catalog_schema(spark, qualified_name(source))
    if source.table is not None:
        return catalog_schema(spark, source.table)
    data = source.schema
    if data is None:
        inferred = spark.read.format(source.format).load(source.path).schema
        data = T.StructType([f for f in inferred.fields if f.name not in source.partition_keys])
    return TableSchema(data, tuple(source.partition_keys))
