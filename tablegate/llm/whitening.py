"""Whitening of vectors from exact second moments by bit slices.

Entries become integers. Each dimension, shifted so that it starts at zero,
is cut into bit planes, and the plane of 64 rows is one machine word. The
product of two dimensions over all rows is then the sum, over their planes a
and b, of 2^(a+b) times the number of ones in the planes' AND. The sums are
exact and are centred as integers, so that the covariance is rounded once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm.storage import stored
from tablegate.llm.words import in_batches

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
MOST = float(1 << 62)  # scaled entries beyond it count as this
PLANE_BYTES = 8 << 20  # planes of one block of rows
WORDS = 256  # words of a plane that are compared at a time
FLAT = 1e-12  # a component with a smaller share of the largest variance has none
LIMB, LIMBS = 48, 4


def usable(vector: Column) -> Column:
    """Vectors that are not null and hold only finite entries."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def as_longs(vector: Column) -> Column:
    """floor(1024 * c) + 100000 of every entry."""
    scaled = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(MOST)), F.lit(-MOST)))
    return F.transform(vector, lambda c: scaled(c).cast("long") + F.lit(OFFSET).cast("long"))


def bit_planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes (one row of words each) of non-negative columns, with the column and the bit of each."""
    rows = -(-len(values) // 64) * 64
    padded = np.zeros((values.shape[1], rows), dtype=np.uint64)
    padded[:, : len(values)] = values.T
    planes, columns, bits = [], [], []
    for column, row in enumerate(padded):
        for bit in range(int(row.max(initial=0)).bit_length()):
            ones = ((row >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
            planes.append(np.packbits(ones).view(np.uint64))
            columns.append(column)
            bits.append(bit)
    return np.array(planes, dtype=np.uint64).reshape(len(planes), rows // 64), np.array(columns, dtype=int), np.array(bits, dtype=int)


def cross_products(values: np.ndarray) -> np.ndarray:
    """Exact sums of products of every two columns (integers of any size), by weighted AND-popcounts."""
    low = values.min(axis=0)
    # int64 differences wrap around, but as unsigned numbers they are right
    planes, columns, bits = bit_planes((values - low).view(np.uint64))
    shifted = np.zeros((values.shape[1], values.shape[1]), dtype=object)
    counts = np.zeros((len(planes), len(planes)), dtype=np.int64)
    for at in range(0, planes.shape[1], WORDS):
        words = np.ascontiguousarray(planes[:, at : at + WORDS])
        for p in range(len(words)):
            counts[p, p:] += np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype=np.int64)
    counts = np.maximum(counts, counts.T)
    if len(planes):
        weight = np.array([1 << b for b in bits.tolist()], dtype=object)
        held, cuts = np.unique(columns, return_index=True)
        weighted = counts.astype(object) * weight[:, None] * weight
        shifted[np.ix_(held, held)] = np.add.reduceat(np.add.reduceat(weighted, cuts, axis=0), cuts, axis=1)
    least = low.astype(object)
    sums = values.astype(object).sum(axis=0) - len(values) * least
    return shifted + np.outer(least, sums) + np.outer(sums, least) + len(values) * np.outer(least, least)


def _limbs(value: int) -> list[int]:
    low = [(value >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(LIMBS - 1)]
    return [*low, value >> (LIMB * (LIMBS - 1))]


@dataclass(frozen=True)
class Whitening:
    """What is learned from all rows: count, exact sums, and the components by falling variance."""

    n: int
    sums: list[int]
    components: np.ndarray  # one row each, of unit length
    variances: np.ndarray
    explained: list[float]


def fit(rows: DataFrame, dims: int, n: int, components: int = COMPONENTS) -> Whitening:
    """Learn from ``x`` (arrays of ``dims`` longs) of all ``n`` rows.

    Each task sends its sums once, dims^2 / 2 numbers; they are added up by
    shuffle, and the same number of totals comes to the driver.
    """
    names = [f"l{k}" for k in range(LIMBS)]
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), *((name, pa.int64()) for name in names)])
    block = 64 * max(1, PLANE_BYTES // (8 * 12 * dims))

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((dims, dims), dtype=object)
        sums = np.zeros(dims, dtype=object)
        for values in _blocks(batches, dims, block):
            products += cross_products(values)
            sums += values.astype(object).sum(axis=0)
        pairs = ((i, j, products[i, j]) for i in range(dims) for j in range(i, dims))
        entries = (*pairs, *((i, -1, sums[i]) for i in range(dims)))
        yield from in_batches(((i, j, *_limbs(int(v))) for i, j, v in entries), schema, 65_536)

    sent = rows.select("x").mapInArrow(scatter, "i int, j int, " + ", ".join(f"{name} long" for name in names))
    totals = sent.groupBy("i", "j").agg(*(F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in names))
    products, sums = np.zeros((dims, dims), dtype=object), [0] * dims
    for row in totals.collect():
        value = sum(int(row[name]) << (LIMB * k) for k, name in enumerate(names))
        if row["j"] < 0:
            sums[row["i"]] = value
        else:
            products[row["i"], row["j"]] = products[row["j"], row["i"]] = value
    # n * P - S S' is n^2 times the covariance, still exact; int / int rounds once
    centred = n * products - np.outer(np.array(sums, dtype=object), np.array(sums, dtype=object))
    covariance = np.array([[c / (n * n) for c in line] for line in centred.tolist()], dtype=np.float64).reshape(dims, dims)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > FLAT * max(values.max(initial=0.0), 0.0)]
    trace = sum(centred[i, i] for i in range(dims)) / (n * n)
    return Whitening(n, sums, vectors[:, order].T.copy(), values[order], [float(v) / trace for v in values[order]])


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, block: int) -> Iterator[np.ndarray]:
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.asarray(batch.column("x").flatten()).reshape(-1, dims)
        for low in range(0, len(values), block):
            held.append(values[low : low + block])
            rows += len(held[-1])
            if rows >= block:
                yield np.concatenate(held)
                held, rows = [], 0
    if held:
        yield np.concatenate(held)


def project(values: np.ndarray, learned: Whitening) -> tuple[list[int | None], np.ndarray]:
    """Exact deviations (null where they are no long) and whitened components of each row."""
    n, sums = learned.n, np.array(learned.sums, dtype=object)
    reach = max((n * abs(int(v)) for v in (values.min(initial=0), values.max(initial=0))), default=0)
    reach += max((abs(s) for s in learned.sums), default=0)
    if values.shape[1] * reach * reach < 1 << 63:
        moved = n * values - sums.astype(np.int64)
        deviation = (moved * moved).sum(axis=1).tolist()
    else:
        moved = n * values.astype(object) - sums
        deviation = [d if d < 1 << 63 else None for d in (moved * moved).sum(axis=1).tolist()]
    centred = (moved / n).astype(np.float64)
    return deviation, centred @ learned.components.T / np.sqrt(learned.variances)


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``vec_id``, ``n``, ``deviation``, ``whitened`` and ``explained`` (arrays, one entry per component), ``identity_error``.

    One row per vector that is not null and holds only finite entries; rows
    with a null id and repeated rows count like any other. Vectors of another
    length than the most frequent one (of equally frequent ones the longest)
    and empty ones take no part. Scaled entries beyond 2^62 count as 2^62, and
    a deviation that is no long is null. Components without variance are left
    out; if there are none at all, or the table is empty, there are no rows.
    Other columns are not read.

    ``identity_error`` is measured over the whitened rows: the largest entry
    of their covariance less the identity.
    """
    found = vectors.where(usable(F.col(vector_column)) & (F.size(vector_column) > 0)).select(
        F.col(id_column).cast("long").alias("vec_id"), as_longs(F.col(vector_column)).alias("x")
    )
    lengths = found.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("dims")).first()
    kinds = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>"
    empty = vectors.sparkSession.createDataFrame([], f"{kinds}, identity_error double")
    if common is None:
        return empty
    dims, n = common
    rows = found.where(F.size("x") == dims)
    learned = fit(rows, dims, n, components)
    count = len(learned.variances)
    if not count:
        return empty
    schema = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = np.asarray(batch.column("x").flatten()).reshape(-1, dims)
                deviation, whitened = project(values, learned)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(whitened.ravel()), count).cast(schema.types[2])
                yield pa.record_batch([batch.column("vec_id"), pa.array(deviation, pa.int64()), flat], schema=schema)

    done = stored(rows.mapInArrow(apply, "vec_id long, deviation long, whitened array<double>"))
    part = [F.col("whitened")[i] for i in range(count)]
    gaps = [F.abs(F.covar_pop(part[i], part[j]) - float(i == j)) for i in range(count) for j in range(i, count)]
    error = max(done.agg(*gaps).first())
    explained = F.array(*(F.lit(e) for e in learned.explained))
    return done.select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
