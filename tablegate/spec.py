"""What to read and what to write: plain descriptions, no Spark state."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

DEFAULT_DATABASE = "default"


def qualified_name(table: str, database: str | None = None) -> str:
    """``db.table``; a missing database means ``default``."""
    if database is None and "." in table:
        return table
    return f"{database or DEFAULT_DATABASE}.{table}"


def quote_name(name: str) -> str:
    """Back-quoted form of a single name."""
    return "`" + name.replace("`", "``") + "`"


def quote_table(table: str) -> str:
    """Back-quoted form of ``db.table``."""
    return ".".join(quote_name(part) for part in table.split("."))


def quote_string(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class DelimitedFormat:
    """Separators of a delimited text table, outermost first.

    The first splits fields; the second splits list items, struct fields and
    map entries; the third splits a map key from its value; further ones serve
    deeper nesting.
    """

    # Default control-character separators and null text.
    separators: tuple[str, ...] = (
        "\x01", "\x02", "\x03", "\x04", "\x05", "\x06", "\x07", "\x08",
    )
    null_text: str = "\\N"

    def __post_init__(self) -> None:
        if not self.separators or any(len(s) != 1 for s in self.separators):
            raise ValueError("each separator is exactly one character")
        if any(s in "\r\n" for s in self.separators):
            raise ValueError("a line break cannot be a separator")

    def separator(self, level: int) -> str:
        if level >= len(self.separators):
            raise ValueError(
                f"nesting level {level} has no separator; {len(self.separators)} given"
            )
        return self.separators[level]


TAB_SEPARATED = DelimitedFormat(separators=("\t", ",", ":"))


@dataclass(frozen=True)
class ReadSpec:
    """A table to read: a catalog table, or files under ``path`` in ``key=value`` directories.

    ``schema`` holds the data columns. It may be left out for self-describing
    files; giving it saves the footer reads and lets old files lack the newer
    columns. ``partition_filter`` is a SQL predicate over the partition keys,
    whose values are strings. For a catalog table only the chosen partitions
    are listed; a path is listed whole. ``num_splits`` asks for about that many input
    splits. ``text_columns`` says that the files are columnar but hold every
    data column as text, which is decoded to the types of ``schema`` by the
    rules for delimited text. ``skip_unreadable`` reads past corrupt or
    vanished files. A bare table name means database ``default``, whatever
    database is current; a temporary view is no table.
    """

    table: str | None = None
    path: str | None = None
    format: str = "parquet"
    schema: T.StructType | None = None
    partition_keys: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()
    partition_filter: str | None = None
    num_splits: int | None = None
    delimited: DelimitedFormat = field(default_factory=DelimitedFormat)
    parse_mode: str = "lazy"
    on_bad: str = "null"
    text_columns: bool = False
    skip_unreadable: bool = False

    def __post_init__(self) -> None:
        if (self.table is None) == (self.path is None):
            raise ValueError("give exactly one of table and path")
        if self.table is not None:
            object.__setattr__(self, "table", qualified_name(self.table))
        if self.format == "delimited" and (self.schema is None or self.path is None):
            raise ValueError("delimited text needs a schema and a path")
        if self.text_columns and (self.schema is None or self.format == "delimited"):
            raise ValueError("columns held as text need a schema and a columnar format")


@dataclass(frozen=True)
class WriteSpec:
    """A catalog table to write to, with the value of every partition key.

    A bare table name means database ``default``, as on a read.
    ``replace_partition`` swaps out an existing partition at commit.
    ``num_files`` is the number of parallel writers (each writes its own
    file); ``max_records_per_file`` starts a new file after that many rows.
    ``max_bytes_per_file`` bounds the bytes of the rows in a file, before
    encoding, whatever their widths (see ``bounded_by_bytes``).
    """

    table: str
    partition: Mapping[str, str] = field(default_factory=dict)
    replace_partition: bool = False
    num_files: int | None = None
    max_records_per_file: int | None = None
    max_bytes_per_file: int | None = None

    def __post_init__(self) -> None:
        if self.max_bytes_per_file is not None and self.num_files is not None:
            raise ValueError("give at most one of num_files and max_bytes_per_file")
        object.__setattr__(self, "table", qualified_name(self.table))
