"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Every word has a sparse random index vector. A word's context vector is the
sum of the index vectors of its neighbours in all texts. A document is the
mean and the spread of its words' vectors, and a network with one hidden
layer turns that into a probability, calibrated by one temperature.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.llm.words import fold

BUCKETS = 1 << 15  # words share these by hash, so the table is as large for any corpus
DIMS = 32
NONZERO = 4
FOLDS = 5  # rows of fold 0 teach nothing
MOST_LABELLED = 20_000  # labelled rows fitted, about; a hash picks them if there are more
HIDDEN = 24
EPOCHS = 60
BATCH = 256
THRESHOLD = 0.3
CHUNK = 1 << 17


def index_vectors(buckets: int = BUCKETS, dims: int = DIMS) -> np.ndarray:
    """Ternary index vectors; the last row, of no word, is zero."""
    random = np.random.default_rng(7)
    table = np.zeros((buckets + 1, dims), dtype=np.int8)
    places = random.permuted(np.tile(np.arange(dims), (buckets, 1)), axis=1)[:, :NONZERO]
    signs = random.choice(np.array([-1, 1], dtype=np.int8), (buckets, NONZERO))
    np.put_along_axis(table[:-1], places, signs, axis=1)
    return table


def word_buckets(raw: bytes) -> np.ndarray:
    words = raw.split()
    return (np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words)) % BUCKETS).astype(np.int64)


def _raw_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
    return [value or b"" for value in values]


def _chunks(texts: Iterator[bytes]) -> Iterator[np.ndarray]:
    """Buckets of many texts with the no-word bucket around each text, in pieces of bounded length."""
    edge = np.array([BUCKETS])
    held, size = [edge], 1
    for raw in texts:
        buckets = word_buckets(raw)
        for low in range(0, len(buckets), CHUNK):
            # pieces of a long text share the word at the cut: each has the neighbour on its side
            part = buckets[low : low + CHUNK + 1]
            held += [part, edge]
            size += len(part) + 1
            if size >= CHUNK:
                yield np.concatenate(held)
                held, size = [edge], 1
    if size > 1:
        yield np.concatenate(held)


def context_sums(docs: DataFrame, text_column: str) -> np.ndarray:
    """Sum of the neighbours' index vectors for every bucket, over all texts; whole numbers, so in any order."""
    names = [f"d{i}" for i in range(DIMS)]
    schema = pa.schema([("bucket", pa.int32()), *((n, pa.int64()) for n in names)])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors().astype(np.float32)
        sums = np.zeros((BUCKETS + 1, DIMS))
        for chunk in _chunks(raw for batch in batches for raw in _raw_texts(batch, "text")):
            inner = chunk[1:-1]
            for d in range(DIMS):
                column = index[:, d][chunk]
                sums[:, d] += np.bincount(inner, weights=column[:-2] + column[2:], minlength=BUCKETS + 1)
        kept = np.flatnonzero(np.any(sums[:-1] != 0, axis=1))
        columns = [pa.array(kept, pa.int32()), *(pa.array(sums[kept, d].astype(np.int64)) for d in range(DIMS))]
        yield pa.record_batch(columns, schema=schema)

    frame = docs.select(F.col(text_column).cast("string").alias("text"))
    partial = frame.mapInArrow(add_up, "bucket int, " + ", ".join(f"{n} long" for n in names))
    # at most BUCKETS rows
    table = partial.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
    sums = np.zeros((BUCKETS + 1, DIMS), dtype=np.float32)
    sums[np.asarray(table.column("bucket"))] = np.column_stack([np.asarray(table.column(n)) for n in names])
    return sums


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Context sums at length one; unseen buckets are zero."""
    lengths = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.where(lengths > 0, sums / np.maximum(lengths, 1e-9), 0).astype(np.float32)


def pool(raw: bytes, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the words' vectors, how alike neighbours are, how varied and how many the words."""
    buckets = word_buckets(raw)
    count = len(buckets)
    total, squares, alike = np.zeros(DIMS), np.zeros(DIMS), 0.0
    for low in range(0, count, CHUNK):
        part = vectors[buckets[low : low + CHUNK + 1]]
        own = part[:CHUNK]
        total += own.sum(axis=0, dtype=np.float64)
        squares += (own * own).sum(axis=0, dtype=np.float64)
        alike += float((part[1:] * part[:-1]).sum())
    n = max(count, 1)
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean * mean, 0))
    seen = np.count_nonzero(np.bincount(buckets, minlength=1)) if count < 64 else len(np.unique(buckets))
    return np.concatenate([mean, spread, [alike / n, seen / n, np.log1p(count)]])


@dataclass
class Network:
    """Standardisation, two layers and a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((pooled - self.centre) / self.scale) @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled) / self.temperature, -30, 30)))


def train(pooled: np.ndarray, quality: np.ndarray, calibrates: np.ndarray) -> Network:
    """Fit the layers by Adam on some rows, the temperature on the rows set aside."""
    random = np.random.default_rng(11)
    size = pooled.shape[1]
    fits = ~calibrates if (~calibrates).any() else np.ones(len(pooled), dtype=bool)
    x, y = pooled[fits], quality[fits].astype(np.float64)
    network = Network(
        x.mean(axis=0), x.std(axis=0) + 1e-3,
        random.normal(0, size**-0.5, (size, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), 0.0,
    )
    x = (x - network.centre) / network.scale
    values = [network.first, network.first_bias, network.second, np.zeros(1)]
    means, squares, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(x))
        rate = 0.01 * (1 - epoch / EPOCHS) + 1e-4
        for low in range(0, len(x), BATCH):
            rows = order[low : low + BATCH]
            hidden = np.tanh(x[rows] @ values[0] + values[1])
            miss = (1 / (1 + np.exp(-(hidden @ values[2] + values[3][0]))) - y[rows]) / len(rows)
            back = np.outer(miss, values[2]) * (1 - hidden**2)
            slopes = [x[rows].T @ back + 1e-4 * values[0], back.sum(axis=0), hidden.T @ miss + 1e-4 * values[2], miss.sum(keepdims=True)]
            step += 1
            for value, mean, square, slope in zip(values, means, squares, slopes, strict=True):
                mean += 0.1 * (slope - mean)
                square += 0.001 * (slope * slope - square)
                value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    network.second_bias = float(values[3][0])
    held = calibrates if calibrates.any() else fits
    logits, truth = network.logits(pooled[held]), quality[held]
    grid = np.geomspace(0.25, 8, 41)
    losses = [np.logaddexp(0, np.where(truth == 1, -logits, logits) / t).mean() for t in grid]
    network.temperature = float(grid[int(np.argmin(losses))])
    return network


@dataclass
class Classifier:
    """What scoring needs: the word vectors and the network (none: every score is one half)."""

    vectors: np.ndarray
    network: Network | None

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.network is None or not texts:
            return np.full(len(texts), 0.5)
        return self.network.scores(np.array([pool(raw, self.vectors) for raw in texts]))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Classifier:
    """Word vectors of all texts, and a network fitted to about ``MOST_LABELLED`` labelled rows outside fold 0.

    An id labelled more than once counts as good if it ever was; null labels
    and ids are ignored. Labels, languages, sources and ids are no inputs.
    """
    vectors = word_vectors(context_sums(docs, text_column))
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(fold(F.col("doc_id"), FOLDS) != 0)
        .groupBy(F.col("doc_id").cast("long").alias("labelled_id"))
        .agg(F.max("quality").cast("int").alias("quality"))
    )
    count = known.count()
    if count > MOST_LABELLED:
        share = int(MOST_LABELLED / count * (1 << 31))
        known = known.where(F.pmod(F.xxhash64("labelled_id"), F.lit(1 << 31)) < share)
    # about MOST_LABELLED rows at most, of two numbers each
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    rows = texts.join(F.broadcast(known), F.col("doc_id") == F.col("labelled_id")).select(
        "doc_id", "quality", (fold(F.col("doc_id"), FOLDS) == 1).alias("calibrates"), "text"
    )
    # rows repeated under one id would lift the bound: keep one text of each
    rows = rows.groupBy("doc_id", "quality", "calibrates").agg(F.min("text").alias("text"))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("quality", pa.int32()), ("calibrates", pa.bool_()), ("pooled", pa.list_(pa.float64()))]
    )

    def pool_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pooled = [pool(raw, vectors).tolist() for raw in _raw_texts(batch, "text")]
            yield pa.record_batch([*batch.columns[:3], pa.array(pooled, schema.types[3])], schema=schema)

    table = rows.mapInArrow(pool_rows, "doc_id long, quality int, calibrates boolean, pooled array<double>").toArrow()
    table = table.sort_by("doc_id")
    quality = np.asarray(table.column("quality"))
    if not len(quality):
        return Classifier(vectors, None)
    pooled = np.asarray(table.column("pooled").combine_chunks().flatten()).reshape(len(quality), -1)
    return Classifier(vectors, train(pooled, quality, np.asarray(table.column("calibrates"))))


def with_score(docs: DataFrame, model: Classifier, text_column: str = "text", name: str = "score") -> DataFrame:
    """All columns of every row, and its score from 0 to 1. A column of that name is replaced.

    A null text is empty; an empty text has a score like any other; repeated
    rows score alike; an empty table gives no rows.
    """
    rows = docs.drop(name)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.score(_raw_texts(batch, text_column)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, name])

    return rows.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row."""
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    scored = with_score(texts, fit(docs, labels, id_column, text_column))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
