"""Words, hashes and whole texts: what several operators share.

A word is a run of ``[^\\x20\\x09-\\x0D]``. On bytes that is exactly what
``bytes.split()`` cuts at, so tasks split UTF-8 bytes, not decoded text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 8 << 20
_CONTINUATION = bytes(range(0x80, 0xC0))


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, mod ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus))


def text_bytes(frame: DataFrame, text: str, *others: Column | str) -> DataFrame:
    """The named columns and the text as UTF-8 bytes (``raw``; null: empty)."""
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("raw")
    return frame.select(*others, raw)


def code_points(raw: bytes) -> int:
    return len(raw) - continuation_bytes(raw)


def continuation_bytes(raw: bytes) -> int:
    return 0 if raw.isascii() else len(raw) - len(raw.translate(None, _CONTINUATION))


def lower_ascii(raw: bytes) -> bytes:
    """A-Z in lower case, all other bytes as they are."""
    return raw.lower()


def rows_within(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, one batch's Python values at a time."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def in_batches(
    rows: Iterator[tuple], schema: pa.Schema, most_rows: int = 4096, weigh: Callable[[tuple], int] | None = None
) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most so many rows, or about ``BATCH_BYTES`` by weight."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += weigh(row) if weigh else 0
        if len(held) >= most_rows or weight >= BATCH_BYTES:
            yield as_batch(held, schema)
            held, weight = [], 0
    if held:
        yield as_batch(held, schema)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
