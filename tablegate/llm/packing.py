"""Packing by column generation for the cutting-stock problem.

Documents longer than a sequence are cut into full pieces and a rest; a rest
above half a sequence is cut once more at the half, since two rests of that
size could never share a sequence. The histogram of piece lengths, not the pieces, is packed: a linear program over
patterns of lengths, whose columns a knapsack dynamic program prices. Rounded
patterns are then dealt to the pieces by their rank among those of their
length class.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.storage import stored
from tablegate.llm.words import in_batches, rows_within, text_bytes

SEQUENCE = 2048
END_ID = 1
CACHE_WORDS = 400_000  # words whose ids a Python worker keeps
LEAST_SALTS = 64
SALT_PIECES = 1_000_000  # pieces of all classes that one salt stands for
CLASS_STEP = 8  # tokens a length class is wide; half of it is lost per piece on average
GAP = 1e-3  # the linear program stops within this share of its bound
STEPS = 4000  # pivots at most; every basis on the way is a valid packing


def length_classes(capacity: int = SEQUENCE, step: int = CLASS_STEP) -> list[int]:
    """Upper ends of the length classes, in equal steps up to half a sequence, and a whole one."""
    return [*range(step, capacity // 2 + 1, step), capacity]


@dataclass(frozen=True)
class Pattern:
    """Pieces per length class in one sequence, and the number of such sequences."""

    pieces: dict[int, int]
    times: int


def _price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """The most valuable pattern that fits: an unbounded knapsack by dynamic programming.

    Sizes and capacity are in class steps here, which all classes are multiples of.
    """
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        n = fitting[room]
        best[room] = best[room - 1]
        if n:
            gains = best[room - sizes[:n]] + values[:n]
            i = int(gains.argmax())
            if gains[i] > best[room] + 1e-12:
                best[room], took[room] = gains[i], i
    pattern: dict[int, int] = {}
    room = capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
            continue
        pattern[took[room]] = pattern.get(took[room], 0) + 1
        room -= sizes[took[room]]
    return best[capacity], pattern


def solve(sizes: list[int], demand: list[int], capacity: int = SEQUENCE) -> list[Pattern]:
    """Patterns that pack the demand of each size (ascending); keys are places in ``sizes``.

    Revised simplex over the patterns found so far, from one pattern per size
    on; ends when no pattern prices in, or within ``GAP`` of the bound that
    the last prices prove. Rounding down leaves at most one sequence per
    pattern, packed by first fit on the counts that remain.
    """
    unit = int(np.gcd.reduce([*sizes, capacity]))
    capacity //= unit
    lengths, wanted = np.array(sizes, dtype=np.int64) // unit, np.array(demand, dtype=np.float64)
    rows = len(lengths)
    if not rows:
        return []
    columns = [{i: int(capacity // size)} for i, size in enumerate(lengths)]
    inverse = np.diag([1.0 / column[i] for i, column in enumerate(columns)])
    used = inverse @ wanted
    bound = 0.0
    for _ in range(STEPS):
        prices = inverse.sum(axis=0)
        value, pattern = _price(np.maximum(prices, 0.0), lengths, capacity)
        bound = max(bound, wanted @ prices / max(value, 1.0))
        if value <= 1 + 1e-9 or used.sum() - bound <= GAP * bound:
            break
        column = np.zeros(rows)
        column[list(pattern)] = list(pattern.values())
        change = inverse @ column
        falls = change > 1e-9
        ratios = np.where(falls, used / np.where(falls, change, 1.0), np.inf)
        leave = int(ratios.argmin())
        step = ratios[leave]
        used = np.maximum(used - step * change, 0.0)
        used[leave] = step
        pivot = inverse[leave] / change[leave]
        inverse -= np.outer(change, pivot)
        inverse[leave] = pivot
        columns[leave] = pattern
    left = np.array(demand, dtype=np.int64)
    patterns = []
    for column, amount in zip(columns, used, strict=True):
        times = min([int(amount + 1e-9), *(int(left[i] // n) for i, n in column.items())])
        if times > 0:
            patterns.append(Pattern(dict(column), times))
            for i, n in column.items():
                left[i] -= n * times
    return patterns + _first_fit(lengths, left, capacity)


def _first_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[Pattern]:
    patterns = []
    while left.any():
        room, pattern = capacity, {}
        for i in range(len(lengths) - 1, -1, -1):
            n = min(int(left[i]), int(room // lengths[i]))
            if n:
                pattern[i] = n
                room -= n * int(lengths[i])
        times = max(1, min(int(left[i] // n) for i, n in pattern.items()))
        for i, n in pattern.items():
            left[i] -= n * times
        patterns.append(Pattern(pattern, times))
    return patterns


class WordIds:
    """Ids of texts, word by word, with what was encoded before kept in bounded caches.

    This vocabulary's tokenizer drops white space, lowers case and never joins
    two words, nor letters with the signs after them. So a word's ids are
    those of its letters and of the signs at its end, and many runs of letters
    are encoded in one text, which ids of word ends cut up again. Words of
    another make are encoded whole.
    """

    SIGNS = b".,!*#$%&;:?)"
    JOINED = 32

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {b"": b""}
        self.is_end = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.is_end[number] = token.endswith("</w>")

    def encode(self, raw: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text."""
        # the marks of special tokens count in their own case only
        words = (raw if b"<|" in raw else raw.lower()).split()
        known = self.words
        try:
            return b"".join([known[word] for word in words])
        except KeyError:
            self._learn({word for word in words if word not in known}, words)
        return b"".join([self.words[word] for word in words])

    def _learn(self, missing: set[bytes], words: list[bytes]) -> None:
        if len(self.words) + len(missing) > CACHE_WORDS:
            self.words.clear()
            missing = set(words)
        if len(self.parts) + 2 * len(missing) > 2 * CACHE_WORDS:
            self.parts = {b"": b""}
        split = {}
        for word in missing:
            stem = word.rstrip(self.SIGNS)
            # lowered: one capital becomes a letter and a mark, which joins with signs
            letters_only = stem.decode("utf-8", "replace").lower().isalpha()
            split[word] = (stem, word[len(stem) :]) if letters_only else (word, b"")
        unknown = {part for pair in split.values() for part in pair if part not in self.parts}
        letters, others = [], []
        for part in unknown:
            text = part.decode("utf-8", "replace")
            (letters if text.lower().isalpha() else others).append((part, text))
        groups = [letters[i : i + self.JOINED] for i in range(0, len(letters), self.JOINED)]
        encoded = self._encoded([" ".join(text for _, text in group) for group in groups])
        for group, ids in zip(groups, encoded, strict=True):
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(group):  # lowering a letter can give two words
                others += group
                continue
            raw, cuts = ids.tobytes(), (4 * ends).tolist()
            for (part, _), low, high in zip(group, [0, *cuts], cuts, strict=False):
                self.parts[part] = raw[low:high]
        for (part, _), ids in zip(others, self._encoded([text for _, text in others]), strict=True):
            self.parts[part] = ids.tobytes()
        self.words.update((word, self.parts[a] + self.parts[b]) for word, (a, b) in split.items())

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        for low in range(0, len(texts), 1024):
            for encoding in self.tokenizer.encode_batch_fast(texts[low : low + 1024], add_special_tokens=False):
                yield np.array(encoding.ids, dtype="<u4")


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per tokenizer file and Python worker."""
    return WordIds(path)


def cut_pieces(docs: DataFrame, tokenizer_path: str, id_column: str, text_column: str, sequence: int) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``size_class``."""
    frame = text_bytes(docs, text_column, F.col(id_column).cast("long").alias("doc_id"))
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    schema = pa.schema([*((name, pa.int64()) for name in names), ("size_class", pa.int32())])
    end = np.array([END_ID], dtype="<u4").tobytes()
    classes = length_classes(sequence)

    def pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
        ids_of = word_ids(tokenizer_path).encode
        for doc_id, raw in rows:
            ids = ids_of(raw) + end
            total = len(ids) // 4
            starts = list(range(0, total, sequence))
            if sequence // 2 < total - starts[-1] < sequence:
                starts.append(starts[-1] + sequence // 2)
            for start, stop in zip(starts, [*starts[1:], total], strict=True):
                length = stop - start
                part = ids[4 * start : 4 * (start + length)]
                yield doc_id, start, length, zlib.crc32(part), total, bisect_left(classes, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(pieces(rows_within(batches)), schema, 16_384)

    return frame.mapInArrow(cut, ", ".join(f"{name} long" for name in names) + ", size_class int")


def plan_table(patterns: list[Pattern], classes: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Rows (size_class, first rank, last rank, pieces per sequence, first sequence)."""
    given = dict.fromkeys(range(len(classes)), 0)
    rows, sequence = [], 0
    for pattern in patterns:
        for size_class, per in pattern.pieces.items():
            first = given[size_class]
            given[size_class] = first + per * pattern.times
            rows.append((size_class, first, given[size_class] - 1, per, sequence))
        sequence += pattern.times
    return rows


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    sequence: int = SEQUENCE,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A null or empty text is its end id alone; repeated rows are packed one by
    one; an empty table gives no rows; other columns are not read. The driver
    sees one count per length class. Ranks within a class are counted in
    salted groups, more of them for more pieces, and shifted by the groups
    before them, so a class with most pieces is no single task's work.
    """
    spark = docs.sparkSession
    cut = cut_pieces(docs, tokenizer_path, id_column, text_column, sequence)
    pieces = stored(cut.withColumn("row", F.monotonically_increasing_id()))
    histogram = {r["size_class"]: r["n"] for r in pieces.groupBy("size_class").agg(F.count("*").alias("n")).collect()}
    salts = max(LEAST_SALTS, sum(histogram.values()) // SALT_PIECES)
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    counts = pieces.groupBy("size_class", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size_class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("size_class", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    classes = length_classes(sequence)
    present = sorted(histogram)
    patterns = solve([classes[c] for c in present], [histogram[c] for c in present], sequence)
    named = [Pattern({present[i]: n for i, n in p.pieces.items()}, p.times) for p in patterns]
    plan = spark.createDataFrame(
        plan_table(named, classes), "size_class int, first long, last long, per long, sequence long"
    )
    within = Window.partitionBy("size_class", "salt").orderBy("row")
    ranked = (
        pieces.withColumn("turn", F.row_number().over(within) - 1)
        .join(shifts, ["size_class", "salt"])
        .withColumn("rank", F.col("turn") + F.col("shift"))
    )
    dealt = ranked.join(F.broadcast(plan), "size_class").where(F.col("rank").between(F.col("first"), F.col("last")))
    placed = dealt.withColumn("sequence_id", F.expr("sequence + (rank - first) div per"))
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "row").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"),
    )
