"""Bit-sliced whitening against plain integer and floating arithmetic."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablegate.llm import whitening
from tablegate.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, n string, x string"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4), st.integers(1, 150), st.integers(0, 62), st.randoms())
def test_cross_products_are_exact(dims, rows, bits, rng):
    values = [[rng.randrange(-(1 << bits), (1 << bits) + 1) for _ in range(dims)] for _ in range(rows)]
    got = whitening.cross_products(np.array(values, dtype=np.int64))
    for i in range(dims):
        for j in range(dims):
            assert got[i, j] == sum(row[i] * row[j] for row in values)
            assert sum(limb << (whitening.LIMB * k) for k, limb in enumerate(whitening._limbs(got[i, j]))) == got[i, j]


def check(rows, vectors, most=whitening.COMPONENTS):
    """rows of the query against numpy on vectors: {vec_id: entries}."""
    x = {i: [math.floor(1024 * float(c)) + 100000 for c in v] for i, v in vectors.items()}
    n, matrix = len(x), np.array(list(x.values()), dtype=float)
    sums = [sum(column) for column in zip(*x.values(), strict=True)]
    covariance = np.cov(matrix.T, bias=True).reshape(matrix.shape[1], -1)
    values, components = np.linalg.eigh(covariance)
    order = [k for k in np.argsort(-values)[:most] if values[k] > 1e-9 * values.max()]
    assert len(rows) == n * len(order)
    by = {(r["vec_id"], r["component"]): r for r in rows}
    assert {i for i, _ in by} == set(x)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] <= 1e-4
    for place, k in enumerate(order, 1):
        expected = (matrix - matrix.mean(axis=0)) @ components[:, k] / math.sqrt(values[k])
        got = np.array([by[i, place]["whitened"] for i in x])
        assert min(np.abs(got - expected).max(), np.abs(got + expected).max()) < 1e-6
        assert by[next(iter(x)), place]["explained"] == pytest.approx(values[k] / np.trace(covariance), rel=1e-9)
    for i, entries in x.items():
        assert by[i, 1]["n"] == n
        assert by[i, 1]["deviation"] == sum((n * c - s) ** 2 for c, s in zip(entries, sums, strict=True))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_equals_numpy(spark, sf):
    table = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet").to_pylist()
    rows = QUERIES["op11_bit_sliced_whitening"](spark, f"/root/testdata/{sf}").collect()
    good = {r["vec_id"]: r["embedding"] for r in table if r["embedding"] is not None}
    good = {i: v for i, v in good.items() if all(c is not None and math.isfinite(c) for c in v)}
    check(rows, good)


def digest(frame):
    return [
        {**row.asDict(), "component": place, "whitened": w, "explained": e}
        for row in whitening.whiten(frame).collect()
        for place, (w, e) in enumerate(zip(row["whitened"], row["explained"], strict=True), 1)
    ]


def test_odd_vectors_take_no_part(spark):
    rng = np.random.default_rng(3)
    good = {i: [float(c) for c in rng.normal(size=3) * (9, 1, 0.1) + 50] for i in range(40)}
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [math.nan, 1.0, 1.0]), (103, [math.inf, 0.0, 0.0]), (104, []), (105, [1.0])]
    rows = [(i, v, "n", "x") for i, v in [*good.items(), *odd]]
    check(digest(spark.createDataFrame(rows, SCHEMA)), good)


def test_repeated_and_zero_vectors_count(spark):
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (None, [1.0, 0.0]), (2, [0.0, 0.5])]
    frame = spark.createDataFrame([(*r, "n", "x") for r in rows], SCHEMA)
    found = digest(frame)
    assert sorted(str(r["vec_id"]) for r in found if r["component"] == 1) == ["1", "1", "2", "None"]
    assert {r["n"] for r in found} == {4} and found[0]["identity_error"] < 1e-9


def test_flat_components_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0], "n", "x") for i in range(5)]
    found = digest(spark.createDataFrame(rows, SCHEMA))
    assert {r["component"] for r in found} == {1} and found[0]["explained"] == pytest.approx(1.0)
    same = spark.createDataFrame([(i, [1.0, 2.0], "n", "x") for i in range(3)], SCHEMA)
    assert whitening.whiten(same).count() == whitening.whiten(same.limit(0)).count() == 0


def test_huge_entries_stay_exact(spark):
    rows = [(0, [1e12, 0.0], "n", "x"), (1, [-1e12, 0.25], "n", "x"), (2, [1e300, 0.5], "n", "x")]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 3 and {r["deviation"] for r in found} == {None}
