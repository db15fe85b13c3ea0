"""Nearest neighbours by a block matrix join.

Vectors are quantised to int8. A tile of integer products gives distances
that are wrong by at most the two quantisation errors, so a pair whose lower
bound exceeds the k-th smallest upper bound cannot be among the nearest. Pairs
that survive are recomputed from the original vectors in double precision and
kept in one bounded heap per query; the heaps of all blocks are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.words import in_batches

K = 10
QUERY_EVERY = 100
BLOCK_BYTES = 8 << 20  # float32 vectors of one block of candidates, and of queries
TILE = 1024
PAIRS = 1 << 16
EXACT_DIMS = 1024  # int8 products of so many dimensions add up exactly in float32


class Quantised:
    """int8 vectors with their scales, lengths and exact quantisation errors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(np.float64)
        self.scale = np.abs(self.vectors).max(axis=1) / 127.0
        # a subnormal vector has scale 0: everything is then quantisation error
        safe = np.where(self.scale > 0, self.scale, 1.0)[:, None]
        self.codes = np.where(self.scale[:, None] > 0, np.rint(self.vectors / safe), 0).astype(np.int8)
        shown = self.codes * self.scale[:, None]
        self.error = np.sqrt(((self.vectors - shown) ** 2).sum(axis=1))
        self.square = (shown**2).sum(axis=1)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact int8 products of all rows, in float64; each slice of dimensions is exact in float32."""
    total = np.zeros((len(left), len(right)))
    for low in range(0, left.shape[1], EXACT_DIMS):
        part = slice(low, low + EXACT_DIMS)
        total += left[:, part].astype(np.float32) @ right[:, part].astype(np.float32).T
    return total


def distance(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows in double precision, dimensions added in order."""
    total = np.zeros(len(left))
    for d in range(left.shape[1]):
        total += (left[:, d] - right[:, d]) ** 2
    return np.sqrt(total)


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> Iterator[tuple[int, int, float]]:
    """The k nearest rows of one block for each query: query id, vector id, distance."""
    left, right = Quantised(queries), Quantised(vectors)
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    bound = np.full(len(query_ids), np.inf)
    for low in range(0, len(query_ids), TILE):
        q = np.arange(low, min(low + TILE, len(query_ids)))
        for start in range(0, len(ids), TILE):
            c = np.arange(start, min(start + TILE, len(ids)))
            dots = products(left.codes[q], right.codes[c]) * left.scale[q][:, None] * right.scale[c]
            near = np.sqrt(np.maximum(left.square[q][:, None] + right.square[c] - 2 * dots, 0.0))
            # rounding of the steps above, far below any quantisation error
            slack = 1e-7 * (np.sqrt(left.square[q])[:, None] + np.sqrt(right.square[c])) + left.error[q][:, None] + right.error[c]
            own = query_ids[q][:, None] == ids[c]
            # components so large that a square overflows give no bound: such pairs are always recomputed
            upper = np.where(own | np.isnan(near + slack), np.inf, near + slack)
            if len(c) >= k:
                bound[q] = np.minimum(bound[q], np.partition(upper, k - 1, axis=1)[:, k - 1])
            a, b = np.nonzero(~own & ~(near - slack > bound[q][:, None]))
            for at in range(0, len(a), PAIRS):
                some, other = q[a[at : at + PAIRS]], c[b[at : at + PAIRS]]
                exact = distance(left.vectors[some], right.vectors[other])
                for i, score, vec in zip(some.tolist(), exact.tolist(), ids[other].tolist(), strict=True):
                    entry = (-score, -vec)
                    if len(heaps[i]) < k:
                        heapq.heappush(heaps[i], entry)
                    elif entry > heaps[i][0]:
                        heapq.heapreplace(heaps[i], entry)
            for i in q.tolist():
                if len(heaps[i]) == k:
                    bound[i] = min(bound[i], -heaps[i][0][0])
    for query_id, heap in zip(query_ids.tolist(), heaps, strict=True):
        for score, vec in heap:
            yield query_id, -vec, -score


def usable(embedding: Column) -> Column:
    """Vectors that take part: not null or empty, only finite components, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0)


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    vectors = table.column("embedding").combine_chunks()
    flat = np.asarray(vectors.flatten(), dtype=np.float64)
    return np.asarray(table.column("vec_id").combine_chunks()), flat.reshape(table.num_rows, -1)


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k nearest rows of each query, exactly.

    Nearest first, ties to the smaller id; fewer rows if there are fewer
    candidates. Rows with a null id or an unusable vector take no part, rows
    of another length are no candidates of a query. Rows that share the
    query's id count as its own; of several query rows with one id the
    smallest vector searches; repeated candidate rows are each returned. An
    empty table gives no rows; other columns are not read.

    Queries are dealt by id and candidates in turn into blocks of a fixed
    number of bytes on average; each pair of blocks is one group of a cogroup,
    so a task holds two blocks. ``is_query`` is a condition on ``id_column``,
    ``vectors`` a scan or a frame whose rows keep their order.
    """
    kind = vectors.schema[vector_column].dataType.simpleString()
    rows = vectors.where(usable(F.col(vector_column)) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("embedding"), is_query.alias("asks")
    )
    dims = F.size("embedding").alias("dims")
    queries = rows.where("asks").groupBy("vec_id").agg(F.min("embedding").alias("embedding")).select("*", dims)
    rows = rows.select("vec_id", "embedding", dims)
    bytes_of = F.coalesce(F.sum(F.col("dims").cast("long") * 4), F.lit(0))
    total, asked = rows.agg(bytes_of).first()[0], queries.agg(bytes_of).first()[0]
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    right_blocks = max(1, -(-total // BLOCK_BYTES), min(cores, total // (BLOCK_BYTES // 16)))
    left_blocks = max(1, -(-asked // BLOCK_BYTES))
    # by id, since the order of aggregated rows may differ when a lost task is repeated
    left = queries.withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(left_blocks))).withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(right_blocks - 1)))
    )
    # in turn, since many rows may share an id; the order of a scan is fixed
    turn = F.monotonically_increasing_id()
    right = rows.withColumn("c", F.pmod(turn, F.lit(right_blocks))).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(left_blocks - 1)))
    )
    keys = ("dims", "q", "c")
    cast = {x: F.col(x).cast("long") for x in ("q", "c")}
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(asking: pa.Table, candidates: pa.Table) -> pa.Table:
        found: Iterator[tuple] = iter(())
        if asking.num_rows and candidates.num_rows:
            found = search_block(*_matrix(asking), *_matrix(candidates), k)
        return pa.Table.from_batches(in_batches(found, schema, 65_536), schema=schema)

    assert kind.startswith("array<")
    pairs = left.withColumns(cast).groupBy(*keys).cogroup(right.withColumns(cast).groupBy(*keys))
    best = pairs.applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
