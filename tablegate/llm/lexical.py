"""Ranked lexical search of many queries at once, sharing their common work.

What a document earns for a term does not depend on the query, so the score
of a query is a plain sum over its terms, and sums that several queries have
in common need to be made once per document. Shared term sets are mined from
the queries: terms that stand in the same queries form one set, and sets that
stand together in several queries are paired again and again. The pairs form
a sharing graph. For each block of documents its nodes hold partial scores,
made once and in order, and every query adds up the few nodes it still has.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.storage import stored
from tablegate.llm.words import in_batches, rows_within, text_bytes

K = 50
BLOCK_PAIRS = 500_000  # (item, term) pairs of one block of items
BLOCK_BYTES = 32 << 20  # partial scores of one block of documents
SALTS = 32

# A term is a run of these characters, A-Z in lower case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_IN_TERM = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
_CLEAN = bytes(bytes([b]).lower()[0] if b in set(_IN_TERM) else 0x20 for b in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(_CLEAN).split()


@dataclass(frozen=True)
class SharedPlan:
    """The sharing graph of one block of items.

    ``terms`` are numbered so that those of one set stand together; sets are
    the first nodes, ``starts`` their first terms. Each level adds nodes that
    are the sum of two earlier ones. ``symbols`` are the nodes that items add
    up, ``cuts`` where each item begins.
    """

    items: list[int | None]
    terms: dict[bytes, int]
    starts: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]
    symbols: np.ndarray
    cuts: np.ndarray

    @property
    def additions(self) -> int:
        """Sums that each document costs, the terms of a set included."""
        paired = sum(len(a) for a, _ in self.levels)
        return len(self.terms) - len(self.starts) + paired + len(self.symbols) - len(self.items)

    @property
    def rows(self) -> int:
        """Numbers held per document."""
        return len(self.terms) + len(self.starts) + sum(len(a) for a, _ in self.levels) + len(self.symbols)


def mine(pairs: Sequence[tuple[int | None, bytes]]) -> SharedPlan:
    """The sharing graph of (item, term) pairs, each given once."""
    holders: dict[bytes, set] = defaultdict(set)
    for item, term in pairs:
        holders[term].add(item)
    items = sorted({item for item, _ in pairs}, key=lambda i: (i is None, i or 0))
    place = {item: at for at, item in enumerate(items)}
    # terms of the same items: one set
    sets: dict[tuple[int, ...], list[bytes]] = defaultdict(list)
    for term in sorted(holders):
        sets[tuple(sorted(place[i] for i in holders[term]))].append(term)
    # sets of most items first: what is shared widely stands side by side
    order = sorted(sets, key=lambda who: (-len(who), who))
    terms = {term: at for at, term in enumerate(t for who in order for t in sets[who])}
    starts = np.cumsum([0, *(len(sets[who]) for who in order)])[:-1]
    lists: list[list[int]] = [[] for _ in items]
    for node, who in enumerate(order):
        for item in who:
            lists[item].append(node)
    lists, levels = _pair_up(lists, len(order))
    symbols = np.array([s for row in lists for s in row], dtype=np.int64)
    cuts = np.cumsum([0, *(len(row) for row in lists)])[:-1]
    return SharedPlan(items, terms, starts.astype(np.int64), levels, symbols, cuts.astype(np.int64))


def _pair_up(lists: list[list[int]], node: int) -> tuple[list[list[int]], list[tuple[np.ndarray, np.ndarray]]]:
    """Replace neighbours that stand in several lists by one new node, until none do."""
    levels = []
    while True:
        seen = Counter(pair for row in lists for pair in zip(row, row[1:]))
        used: Counter = Counter()
        plans = []
        for row in lists:
            at, chosen = 0, []
            while at < len(row) - 1:
                here = seen[row[at], row[at + 1]]
                after = seen[row[at + 1], row[at + 2]] if at + 2 < len(row) else 0
                if here > 1 and here >= after:
                    chosen.append(at)
                    used[row[at], row[at + 1]] += 1
                    at += 1
                at += 1
            plans.append(chosen)
        fresh = sorted(pair for pair, times in used.items() if times > 1)
        if not fresh:
            return lists, levels
        names = {pair: node + at for at, pair in enumerate(fresh)}
        node += len(fresh)
        levels.append((np.array([a for a, _ in fresh]), np.array([b for _, b in fresh])))
        lists = [_replaced(row, chosen, names) for row, chosen in zip(lists, plans, strict=True)]


def _replaced(row: list[int], chosen: list[int], names: dict[tuple[int, int], int]) -> list[int]:
    out, at = [], 0
    for start in [*chosen, len(row)]:
        out.extend(row[at:start])
        at = start
        if start < len(row):
            name = names.get((row[start], row[start + 1]))
            out.extend(row[start : start + 2] if name is None else [name])
            at = start + 2
    return out


def evaluate(
    plan: SharedPlan, weights: np.ndarray, lengths: np.ndarray, counts: np.ndarray, terms: np.ndarray, tf: np.ndarray
) -> np.ndarray:
    """Scores, one row per item and a column per document, in 64-bit integers.

    ``lengths`` are the documents' m, ``counts`` how many of ``terms`` (each
    once per document) and ``tf`` belong to each.
    """
    docs = np.repeat(np.arange(len(counts)), counts)
    earned = np.zeros((len(plan.terms), len(counts)), dtype=np.int64)
    earned[terms, docs] = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * lengths[docs]))
    nodes = np.empty((plan.rows - len(plan.terms) - len(plan.symbols), len(counts)), dtype=np.int64)
    at = len(plan.starts)
    np.add.reduceat(earned, plan.starts, axis=0, out=nodes[:at])
    for left, right in plan.levels:
        nodes[at : at + len(left)] = nodes[left] + nodes[right]
        at += len(left)
    return np.add.reduceat(nodes[plan.symbols], plan.cuts, axis=0)


class Best:
    """The k best documents of each item so far: higher score, then smaller id (no id last)."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, dtype=np.int64)
        self.held = [np.zeros(0, dtype=np.int64)] * 4
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.rows, self.most = 0, max(1 << 16, 4 * k * items)

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.waiting.append((item, scores[item, doc], missing[doc], ids[doc]))
        self.rows += len(item)
        if self.rows > self.most:
            self.settle()

    def settle(self) -> list[np.ndarray]:
        item, score, missing, ids = (np.concatenate(x) for x in zip(self.held, *self.waiting, strict=True))
        order = np.lexsort((ids, missing, -score, item))
        item = item[order]
        first = np.searchsorted(item, item, side="left")
        place = np.arange(len(item)) - first
        kept = order[place < self.k]
        last = place == self.k - 1
        self.least[item[last]] = score[order[last]]
        inverse = [np.concatenate(x)[kept] for x in zip(self.held, *self.waiting, strict=True)]
        self.held, self.waiting, self.rows = inverse, [], 0
        return inverse


def postings(docs: DataFrame, plan: SharedPlan, id_column: str, text_column: str) -> DataFrame:
    """``doc_id``, ``n`` (terms with repeats), and the plan's terms with their counts, of every text with a term."""
    frame = text_bytes(docs, text_column, F.col(id_column).cast("long").alias("doc_id"))
    known = plan.terms
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc_id, raw in rows_within(batches):
                words = terms_of(raw)
                if words:
                    found = {known[w]: c for w, c in Counter(words).items() if w in known}
                    yield doc_id, len(words), list(found), list(found.values())

        yield from in_batches(rows(), schema, weigh=lambda row: 16 * len(row[2]) + 16)

    return frame.mapInArrow(count, "doc_id long, n long, terms array<int>, tf array<long>")


def _search_block(docs: DataFrame, plan: SharedPlan, k: int, id_column: str, text_column: str) -> DataFrame:
    counted = stored(postings(docs, plan, id_column, text_column))
    total, length = counted.agg(F.count("*"), F.sum("n")).first()
    frequency = np.zeros(len(plan.terms), dtype=np.int64)
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
        frequency[row["term"]] = row["df"]
    weights = np.array(
        [math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) for df in frequency.tolist()], dtype=np.int64
    )
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    size = max(1, min(2048, BLOCK_BYTES // (8 * plan.rows)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(plan.items), k)
        for whole in batches:
            for low in range(0, whole.num_rows, size):
                part = whole.slice(low, size)
                ids, n, terms, tf = part.columns
                lengths = 50 + (50 * np.asarray(n) * total) // length
                scores = evaluate(
                    plan, weights, lengths, np.asarray(terms.value_lengths()),
                    np.asarray(terms.flatten()), np.asarray(tf.flatten()),
                )
                best.add(scores, np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()).astype(np.int64))
        item, points, missing, ids = best.settle()
        rows = zip(item.tolist(), ids.tolist(), missing.tolist(), points.tolist(), strict=True)
        yield from in_batches(((plan.items[i], None if gone else d, s) for i, d, gone, s in rows), schema, 65_536)

    return counted.mapInArrow(score, "item_id long, doc_id long, score long")


def item_terms(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """``item_id``, ``term`` (as bytes), each pair once; items without a term have no row."""
    found = F.regexp_extract_all(F.translate(F.col(text_column), UPPER, LOWER), F.lit(TERM), F.lit(0))
    rows = items.select(F.col(id_column).cast("long").alias("item_id"), F.explode(found).alias("term"))
    return rows.select("item_id", F.col("term").cast("binary").alias("term")).distinct()


def _block_count(pairs: DataFrame, most: int) -> int:
    """So many blocks that each holds at most ``most`` pairs, or one item."""
    blocks = max(1, -(-pairs.count() // most))
    while True:
        sizes = pairs.groupBy(_block(blocks).alias("block")).agg(
            F.count("*").alias("n"), F.min("item_id").alias("a"), F.max("item_id").alias("b")
        )
        if not sizes.where((F.col("n") > most) & (F.col("a") != F.col("b"))).head(1):
            return blocks
        blocks *= 2


def _block(blocks: int):
    return F.pmod(F.xxhash64("item_id"), F.lit(blocks))


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the k best documents of every item.

    Scores are integers, above 0; equal scores by ascending id, documents
    without an id last. Null and empty texts have no terms; rows repeated in
    ``docs`` are documents of their own; rows of one ``item_id`` (or of none)
    are one item with the terms of all. Empty tables give no rows; other
    columns are not read.

    Items are searched in blocks of at most ``BLOCK_PAIRS`` (item, term) pairs
    (or one item), whose graph is what each task is sent: as a rule there is
    one block. A block reads all texts once and keeps the counts of its terms
    in the shared folder. To the driver come the pairs of one block and one
    number per term. A task holds one block of documents and its own k best
    of every item; these meet in salted groups first, then per item.
    """
    pairs = stored(item_terms(items, item_column, item_text))
    blocks = _block_count(pairs, BLOCK_PAIRS)
    found = None
    for block in range(blocks):
        rows = [(row[0], bytes(row[1])) for row in pairs.where(_block(blocks) == block).toLocalIterator()]
        if not rows:
            continue
        part = _search_block(docs, mine(rows), k, id_column, text_column)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.spark_partition_id() % SALTS)
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*best)))
    near = first.where(F.col("rank") <= k).drop("rank", "salt")
    last = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best)))
    return last.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
