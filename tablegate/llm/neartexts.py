"""Near copies of whole texts: SimHash and the Gray-order index, with links held to an exact similarity.

Two texts are near copies if their sets of word shingles have a Jaccard
similarity of ``ALIKE`` or more. Their SimHash fingerprints then differ in
about ten of 64 bits, which blocks of bits cannot route. So runs of min-hashes
of the shingles choose the groups, the Gray-order tree searches each group with
a wide limit, a sketch of min-hashes thins what it finds, and every link that
is left is compared by its whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.components import connected_components
from tablegate.llm.simhash import FAN_OUT, GrayIndex, gray_rank, hashed_shingles, set_bits, signed
from tablegate.llm.storage import stored
from tablegate.llm.words import in_batches, rows_within, text_bytes

SHINGLE = 5
ALIKE = 0.8
WIDE = 20  # bits; at a similarity of 0.8 the mean is 9.7, the deviation 2.9
HASHES = 128
BANDS, RUN = 12, 5  # 99 % of the pairs at 0.8 share a run of min-hashes
ESTIMATES = (102, 90)  # equal min-hashes of 128 that make a link, stronger first; at 0.8 the mean is 102.5, the deviation 4.5
GROUP_ROWS = 20_000  # a larger group is cut into parts, and every two parts meet
FRONTIER = 1 << 17
_SLICE = 1024

_draw = np.random.default_rng(5)
_FACTORS = (_draw.integers(0, 1 << 63, HASHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFTS = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def profile(raw: bytes, width: int = SHINGLE) -> tuple[int, list[int], bytes]:
    """Fingerprint, hashes of the runs of min-hashes, and one byte of each min-hash of a whole text."""
    counts, total = np.zeros(64, dtype=np.int64), 0
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for hashes in hashed_shingles(raw, width):
        counts += set_bits(hashes)
        total += len(hashes)
        for low in range(0, len(hashes), _SLICE):
            part = np.multiply.outer(_FACTORS, hashes[low : low + _SLICE])
            part += _SHIFTS[:, None]
            np.minimum(least, part.min(axis=1), out=least)
    fp = sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist())
    runs = [signed(xxhash.xxh64_intdigest(least[i * RUN : (i + 1) * RUN].tobytes(), i)) for i in range(BANDS)]
    return signed(fp), runs, ((least * _MIX) >> np.uint64(56)).astype(np.uint8).tobytes()


def shingle_set(raw: bytes, width: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of a text's shingles."""
    parts = list(hashed_shingles(raw, width))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.uint64)


class SketchIndex(GrayIndex):
    """The Gray-order tree over a group, with links that their sketches bear out.

    ``links`` become a spanning forest of pairs that were found, those of the
    strongest estimates first. Fingerprints may repeat.
    """

    def __init__(self, values: np.ndarray, sketches: np.ndarray, most: int = WIDE):
        order = np.argsort(gray_rank(values), kind="stable")
        super().__init__(values[order], most)
        self.places, self.sketches, self.links = order, sketches[order], []

    def link_all(self) -> None:
        count = len(self.values)
        for self.equal in ESTIMATES:
            # neighbours first: most of a dense group is joined before its searches start
            for step in (1, 2, 3):
                self._join(np.arange(max(count - step, 0)), np.arange(step, max(count, step)))
            super().link_all()

    def _search(self, queries: np.ndarray) -> None:
        """As the tree's search, its frontier in pieces, so that memory is bounded."""
        uniform = self._uniform()
        zeros = np.zeros(len(queries), dtype=np.int64)
        waiting = [(0, queries, zeros, zeros)]
        while waiting:
            level, query, node, spent = waiting.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                waiting.append((level, query[half:], node[half:], spent[half:]))
                waiting.append((level, query[:half], node[:half], spent[:half]))
                continue
            pattern, own = self.patterns[level], self.own[level]
            spent = spent + np.bitwise_count((self.values[query] ^ pattern[node]) & own[node])
            keep = (spent <= self.most) & (uniform[level][node] != self.labels[query])
            query, node, spent = query[keep], node[keep], spent[keep]
            if level + 1 == len(self.patterns):
                self._join(query, node)
            elif len(query):
                below = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                inside = below < len(self.patterns[level + 1])
                query, spent = np.repeat(query, FAN_OUT), np.repeat(spent, FAN_OUT)
                waiting.append((level + 1, query[inside], below[inside], spent[inside]))

    def _join(self, left: np.ndarray, right: np.ndarray) -> None:
        for low in range(0, len(left), _SLICE * 8):
            self._join_some(left[low : low + _SLICE * 8], right[low : low + _SLICE * 8])

    def _join_some(self, left: np.ndarray, right: np.ndarray) -> None:
        apart = self.labels[left] != self.labels[right]
        left, right = left[apart], right[apart]
        alike = (self.sketches[left] == self.sketches[right]).sum(axis=1) >= self.equal
        left, right = left[alike], right[alike]
        while len(left):
            a, b = self.labels[left], self.labels[right]
            upper, lower = np.maximum(a, b), np.minimum(a, b)
            # every component hangs itself on a smaller one by one pair: no rings
            hung, chosen = np.unique(upper, return_index=True)
            self.links.extend(zip(self.places[left[chosen]].tolist(), self.places[right[chosen]].tolist(), strict=True))
            target = np.arange(len(self.labels))
            target[hung] = lower[chosen]
            while not np.array_equal(further := target[target], target):
                target = further
            self.labels = target[self.labels]
            apart = self.labels[left] != self.labels[right]
            left, right = left[apart], right[apart]


def digest(text: Column) -> Column:
    """64 bits that name a text: null and empty are one; other texts meet by chance only, one pair in 2^64."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _profiles(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    named = docs.where(F.col(id_column).isNotNull())
    frame = text_bytes(
        named, text_column, F.col(id_column).cast("long").alias("doc_id"), digest(F.col(text_column)).alias("digest")
    )
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("digest", pa.int64()),
            ("fp", pa.int64()),
            ("runs", pa.list_(pa.int64())),
            ("sketch", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(((i, d, *profile(raw)) for i, d, raw in rows_within(batches)), schema)

    return frame.mapInArrow(run, "doc_id long, digest long, fp long, runs array<long>, sketch binary")


def candidate_links(texts: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links ``a``, ``b`` of digests that the index finds and the sketches bear out.

    ``texts`` holds each ``digest`` once, with ``fp``, ``runs`` and ``sketch``.
    Only texts that share a run with another are moved with their sketches. A
    group above ``group_rows`` is cut into parts and every two parts form a
    group, so a task holds at most about that many rows and no pair is lost.
    """
    keyed = texts.select("digest", F.explode("runs").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = keyed.join(sizes, "key").join(texts.select("digest", "fp", "sketch"), "digest")
    parts = F.when(F.col("n") > group_rows, F.ceil(2 * F.col("n") / F.lit(group_rows))).otherwise(1).cast("int")
    part = F.pmod(F.xxhash64("digest", F.lit("part")), F.col("parts")).cast("int")
    met = shared.withColumn("parts", parts).withColumn("part", part)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other"))
    group = F.when(F.col("parts") > 1, pair).otherwise(F.col("key"))
    ordered = met.select(group.alias("key"), "digest", "fp", "sketch").repartition("key").sortWithinPartitions("key")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(_group_links(batches), schema, 65_536)

    return ordered.mapInArrow(search, "a long, b long").distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[np.ndarray, ...]]]:
    """Digests, fingerprints and sketches of each key, in pieces; the rows come sorted by key."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, digests, values = (np.asarray(column) for column in batch.columns[:3])
        sketches = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint8).reshape(-1, HASHES)
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if parts and keys[low] != key:
                yield parts
                parts = []
            key = keys[low]
            parts.append((digests[low:high], values[low:high].view(np.uint64), sketches[low:high]))
    if parts:
        yield parts


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
    for parts in _groups(batches):
        digests, values, sketches = (np.concatenate(column) for column in zip(*parts, strict=True))
        if len(digests) > 1:
            index = SketchIndex(values, sketches)
            index.link_all()
            yield from ((min(a, b), max(a, b)) for a, b in ((int(digests[i]), int(digests[j])) for i, j in index.links))


def _sets(docs: DataFrame, nodes: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``digest`` and the hashed shingles of the texts in ``nodes`` (``digest``, ``first``), each once."""
    named = docs.select(
        F.col(id_column).cast("long").alias("first"), digest(F.col(text_column)).alias("digest"), F.col(text_column).alias("text")
    )
    wanted = text_bytes(named.join(nodes.hint("merge"), ["digest", "first"]), "text", "digest")
    schema = pa.schema([("digest", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((d, shingle_set(raw).view(np.int64)) for d, raw in rows_within(batches))
        yield from in_batches(rows, schema, weigh=lambda row: row[1].nbytes)

    sets = wanted.mapInArrow(run, "digest long, shingles array<long>")
    return sets.groupBy("digest").agg(F.first("shingles").alias("shingles"))


def alike_links(docs: DataFrame, links: DataFrame, nodes: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The ``links`` whose whole shingle sets have a similarity of ``ALIKE`` or more; two empty sets are alike."""
    ends = links.select(F.explode(F.array("a", "b")).alias("digest")).distinct()
    sets = stored(_sets(docs, nodes.join(ends, "digest"), id_column, text_column))
    left = sets.select(F.col("digest").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("right"))
    both = links.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    shared = F.size(F.array_intersect("left", "right"))
    total = F.size("left") + F.size("right") - shared
    return both.where((total == 0) | (shared >= F.lit(ALIKE) * total)).select("a", "b")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``digest`` of the text that stays of each group of near copies: that of the smallest id.

    Groups are what links join, directly or in steps. Texts that are equal
    count once. Rows without an id belong to no group.
    """
    texts = stored(
        stored(_profiles(docs, id_column, text_column))
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first"), *(F.first(c).alias(c) for c in ("fp", "runs", "sketch")))
    )
    nodes = texts.select("digest", "first")
    links = stored(candidate_links(texts))
    roots = connected_components(alike_links(docs, links, nodes, id_column, text_column))
    rooted = nodes.join(roots.withColumnRenamed("node", "digest").hint("merge"), "digest", "left")
    least = rooted.groupBy(F.coalesce("root", "digest").alias("root")).agg(F.min(F.struct("first", "digest")).alias("kept"))
    return least.select(F.col("kept.first").alias("doc_id"), F.col("kept.digest").alias("digest"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the one of the smallest id.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lowered; a text of fewer
    than five is one shingle, and texts without words (null, empty) are alike.
    Rows repeated under one id are told apart by their texts; of those with
    the same text the first by their columns as JSON stays. Rows without an id
    cannot be named and all stay. An empty table gives no rows. Columns are
    those of ``docs``, whatever their names.
    """
    row = F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, F.col(id_column).cast("long").alias("doc_id"), digest(F.col(text_column)).alias("digest"))
    kept = stored(one_of_each(docs, id_column, text_column))
    # the kept ids grow with the documents: shuffled at every size, never broadcast
    found = rows.join(kept.hint("merge"), ["doc_id", "digest"])
    ranked = found.withColumn(
        "place", F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy(F.to_json("row")))
    )
    return ranked.where("place = 1").unionByName(rows.where(F.col("doc_id").isNull()).withColumn("place", F.lit(1))).select("row.*")
