"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints are sorted by Gray rank, so that neighbours differ in few bits.
Groups of neighbours form a tree; a node holds the bits that all below it
share, less those its own parent holds already. A search adds up differences
on the way down and leaves a whole group as soon as they pass the limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.components import connected_components
from tablegate.llm.sizes import join_small
from tablegate.llm.storage import stored
from tablegate.llm.words import in_batches, lower_ascii, rows_within, text_bytes

SHINGLE = 4
SEED = 42
MOST_DIFFERENT = 4
FAN_OUT = 8
GROUP_ROWS = 500_000  # a larger routing group is routed again by further bits
HOT_ROWS = 20_000  # copies of one fingerprint above this are joined apart
_CHUNK = 1 << 16
_ALL = (1 << 64) - 1


def hashed_shingles(raw: bytes, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of a whole text's shingles in order, repeats included, in pieces; nothing for a text without words."""
    words = lower_ascii(raw).split()
    if not words:
        return
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    width = min(width, len(words))
    starts = [0, *ends[: len(words) - width]]
    for low in range(0, len(starts), _CHUNK):
        high = min(low + _CHUNK, len(starts))
        spans = zip(starts[low:high], ends[low + width - 1 : high + width - 1], strict=True)
        yield np.array([xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in spans], dtype="<u8")


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes set each of the 64 bits."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int32)


def fingerprint(raw: bytes, width: int = SHINGLE) -> int:
    """SimHash of a whole text: a bit is 1 if set in over half of the shingles' hashes."""
    counts, total = np.zeros(64, dtype=np.int64), 0
    for hashes in hashed_shingles(raw, width):
        counts += set_bits(hashes)
        total += len(hashes)
    return sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist())


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) of every row; a null text is empty."""
    frame = text_bytes(docs, text_column, F.col(id_column).cast("long").alias("doc_id"))
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = ((i, signed(fingerprint(raw))) for i, raw in rows_within(batches))
        yield from in_batches(prints, schema)

    return frame.mapInArrow(run, "doc_id long, fp long")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each value in the reflected Gray order."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """The tree over distinct fingerprints, and the links its searches find."""

    def __init__(self, values: np.ndarray, most: int = MOST_DIFFERENT):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        self.most = most
        shared = np.full(len(values), _ALL, dtype=np.uint64)
        levels = [(self.values, shared)]
        while len(levels[-1][0]) > 1:
            pattern, mask = levels[-1]
            cuts = np.arange(0, len(pattern), FAN_OUT)
            ones = np.bitwise_and.reduceat(pattern & mask, cuts)
            zeros = np.bitwise_and.reduceat(~pattern & mask, cuts)
            levels.append((ones, ones | zeros))
        levels.reverse()
        self.patterns = [pattern for pattern, _ in levels]
        self.shared = [mask for _, mask in levels]
        # below the root a node keeps only the bits that its parent does not hold
        self.own = [self.shared[0]] + [
            mask & ~np.repeat(parent, FAN_OUT)[: len(mask)] for parent, mask in zip(self.shared, self.shared[1:])
        ]
        self.labels = np.arange(len(values))

    def link_all(self) -> None:
        """Give all values that are linked, directly or not, the label of the first of them.

        Searches run for blocks of fingerprints. What earlier blocks joined is
        passed over: a group that lies in the searcher's own component has
        nothing new, so a dense group costs one pass and not all its pairs.
        """
        count = len(self.values)
        block = max(64, min(2048, count // 16))
        for low in range(0, count, block):
            self._search(np.arange(low, min(low + block, count)))

    def _uniform(self) -> list[np.ndarray]:
        """Per level, the component that all values below a node share, or -1."""
        levels = [self.labels]
        for _ in self.patterns[1:]:
            below = levels[-1]
            cuts = np.arange(0, len(below), FAN_OUT)
            low, high = np.minimum.reduceat(below, cuts), np.maximum.reduceat(below, cuts)
            levels.append(np.where(low == high, low, -1))
        return levels[::-1]

    def _search(self, queries: np.ndarray) -> None:
        uniform = self._uniform()
        query, node = queries, np.zeros(len(queries), dtype=np.int64)
        spent = np.zeros(len(queries), dtype=np.int64)
        for level, (pattern, own) in enumerate(zip(self.patterns, self.own, strict=True)):
            if level:
                query, spent = np.repeat(query, FAN_OUT), np.repeat(spent, FAN_OUT)
                node = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                inside = node < len(pattern)
                query, spent, node = query[inside], spent[inside], node[inside]
            spent = spent + np.bitwise_count((self.values[query] ^ pattern[node]) & own[node])
            keep = (spent <= self.most) & (uniform[level][node] != self.labels[query])
            query, node, spent = query[keep], node[keep], spent[keep]
        self._join(query, node)

    def _join(self, left: np.ndarray, right: np.ndarray) -> None:
        labels = self.labels
        while True:
            a, b = labels[left], labels[right]
            apart = a != b
            if not apart.any():
                return
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
            while True:
                jumped = labels[labels]
                if np.array_equal(jumped, labels):
                    break
                labels = jumped
            self.labels = labels


def _blocks(free: int, most: int = MOST_DIFFERENT) -> list[int]:
    """Masks that cut the free bits into one block more than bits may differ."""
    places = [i for i in range(64) if free >> i & 1]
    parts = most + 1
    cuts = [len(places) * i // parts for i in range(parts + 1)]
    return [sum(1 << p for p in places[a:b]) for a, b in zip(cuts, cuts[1:])]


def _route(frame: DataFrame, fixed: Column, masks: list[tuple[int, int]]) -> DataFrame:
    """A copy of each row per mask, keyed by ``fixed`` and the masked bits; equal hashes only merge groups."""
    choices = F.array(*(F.struct(F.lit(i).alias("mask"), F.lit(signed(m)).alias("bits")) for i, m in masks))
    copies = frame.withColumn("choice", F.explode(choices))
    key = F.xxhash64(fixed, F.col("choice.mask"), F.col("fp").bitwiseAND(F.col("choice.bits")))
    return copies.select("fp", key.alias("key"), F.col("choice.mask").alias("mask"))


def near_links(distinct: DataFrame, most: int = MOST_DIFFERENT) -> DataFrame:
    """Links ``a``, ``b`` that join all distinct ``fp`` within ``most`` bits, directly or in steps.

    Two such fingerprints agree on one of ``most + 1`` blocks of bits, so each
    is routed once per block and every group is searched by its own index.
    A group above ``GROUP_ROWS`` is routed once more by blocks of its free
    bits, which keeps every link. A group of n gives at most n - 1 links.
    """
    first = _blocks(_ALL, most)
    rows = _route(distinct, F.lit(0), list(enumerate(first)))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > GROUP_ROWS)
    large = stored(sizes.select("key"))
    if large.head(1):
        flagged = rows.join(large.withColumn("large", F.lit(True)), "key", "left")
        again = [
            _route(flagged.where(F.col("large") & (F.col("mask") == i)), F.col("key"), list(enumerate(_blocks(_ALL & ~m, most))))
            for i, m in enumerate(first)
        ]
        rows = flagged.where(F.col("large").isNull()).select("fp", "key", "mask")
        for part in again:
            rows = rows.unionByName(part)
    ordered = rows.select("key", "fp").repartition("key").sortWithinPartitions("key")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(_group_links(batches, most), schema, 65_536)

    return ordered.mapInArrow(search, "a long, b long").distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Fingerprints of each key; the rows come sorted by key."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, values = (np.asarray(column) for column in batch.columns)
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if parts and keys[low] != key:
                yield np.concatenate(parts)
                parts = []
            key = keys[low]
            parts.append(values[low:high])
    if parts:
        yield np.concatenate(parts)


def _group_links(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple]:
    for group in _groups(batches):
        if len(group) < 2:
            continue
        index = GrayIndex(np.unique(group.view(np.uint64)), most)
        index.link_all()
        heads = index.values[index.labels]
        linked = heads != index.values
        yield from zip(index.values[linked].view(np.int64).tolist(), heads[linked].view(np.int64).tolist(), strict=True)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Null and empty texts have fingerprint zero and are linked like any other.
    Equal fingerprints are one node of the search, so copies make no pairs.
    ``component_id`` is the smallest id that can be reached (null only if the
    whole component has none); repeated rows stay; an empty table gives no
    rows; other columns are not read.
    """
    prints = stored(fingerprints(docs, id_column, text_column))
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    roots = connected_components(near_links(distinct.select("fp")))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("size")))
    large = least.where(F.col("size") > HOT_ROWS).select("root", "component_id")
    joined = rooted.join(least.where(F.col("size") <= HOT_ROWS).select("root", "component_id"), "root")
    if large.head(1):
        # a component with a third of all fingerprints does not meet in one task
        joined = joined.unionByName(join_small(rooted, large, "root", [F.col("fp")]).select(*joined.columns))
    named = stored(joined.select("fp", "n", "component_id"))
    hot = named.where(F.col("n") > HOT_ROWS).select("fp", "component_id")
    marked = prints.join(named.where(F.col("n") <= HOT_ROWS).select("fp", "component_id"), "fp")
    if hot.head(1):
        apart = join_small(prints, hot, "fp", [F.col("doc_id")])
        marked = marked.unionByName(apart.select(*marked.columns))
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.select("doc_id", hexadecimal.alias("fingerprint"), "component_id")

