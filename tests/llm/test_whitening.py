"""Jacobi-Davidson whitening against a dense solver."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from echolot.llm import whitening
from echolot.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "dimensions, wanted, kind",
    [(64, 8, "bulk"), (200, 8, "bulk"), (30, 8, "rank"), (5, 8, "bulk"), (1, 3, "bulk"), (120, 8, "equal"), (150, 4, "close")],
)
def test_pairs_equal_a_dense_solver(dimensions, wanted, kind):
    draw = np.random.default_rng(dimensions)
    turn, _ = np.linalg.qr(draw.standard_normal((dimensions, dimensions)))
    values = {
        "bulk": draw.uniform(1, 2, dimensions), "rank": np.r_[3.0, 2.0, 1.0, np.zeros(max(0, dimensions - 3))][:dimensions],
        "equal": np.r_[np.full(5, 9.0), np.ones(max(0, dimensions - 5))][:dimensions],
        "close": 1 + 1e-5 * np.arange(dimensions),
    }[kind]
    matrix = (turn * values) @ turn.T
    vectors, found = whitening.leading_pairs(lambda x: matrix @ x, dimensions, wanted)
    k = min(wanted, dimensions)
    assert np.allclose(found, np.sort(values)[::-1][:k], rtol=0, atol=1e-13 * values.max())
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * values.max()
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-13)


def test_query_equals_a_dense_solver(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.floor(1024 * np.array([r.embedding for r in rows], float)) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    want = centred @ vectors / np.sqrt(values)
    place = {r.vec_id: i for i, r in enumerate(rows)}
    got = np.zeros_like(want)
    exact = ((n * x.astype(np.int64).astype(object) - sums.astype(np.int64).astype(object)) ** 2).sum(axis=1)
    result = QUERIES["op11_jacobi_davidson"](spark, SF).collect()
    for r in result:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert (r.n, r.deviation) == (n, exact[place[r.vec_id]])
        assert math.isclose(r.explained, values[r.component - 1] * n / np.square(centred).sum(), rel_tol=1e-10)
        assert r.identity_error < 1e-10
    assert len(result) == 8 * n
    assert np.allclose(got * np.sign((got * want).sum(axis=0)), want, atol=1e-8)


SCHEMA = "vec_id long, embedding array<double>, n long, component string"


def test_edges(spark):
    """Nulls, NaN, infinities, empty vectors, repeated rows, clashing names, an empty table."""
    rows = [
        (1, [0.5, 1.0]), (2, [1.5, -2.0]), (2, [1.5, -2.0]), (None, [0.0, 0.25]), (3, None), (4, [None, 1.0]),
        (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (7, []),
    ]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA)
    got = whitening.report(df, "vec_id", "embedding").collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == sorted(
        (v is None, v or 0, c) for v in (1, 2, 2, None) for c in (1, 2)
    )
    assert all(r.n == 4 and r.identity_error < 1e-9 for r in got)
    assert whitening.report(df.limit(0), "vec_id", "embedding").count() == 0
    equal = spark.createDataFrame([(i, [1.0, 2.0], 1, "") for i in range(4)], SCHEMA)
    assert whitening.report(equal, "vec_id", "embedding").count() == 0


def test_large_entries_stay_exact_or_are_refused(spark):
    wide = spark.createDataFrame([(i, [1e8 * (-1) ** i, 3.0 * i], 1, "") for i in range(5)], SCHEMA)
    table = whitening.blocks_of(wide, "vec_id", "embedding", 1024, 100_000)
    got = {r.id: int(r.deviation) for r in whitening.whiten(table, whitening.fit(table)).collect()}
    x = [[math.floor(1024 * v) + 100_000 for v in r.embedding] for r in wide.collect()]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert got == {i: sum((5 * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for i, row in enumerate(x)}
    assert max(got.values()) > 2**63
    assert {r.deviation for r in whitening.report(wide, "vec_id", "embedding").collect()} == {None}
    with pytest.raises(PythonException, match="row 7"):
        whitening.blocks_of(wide.withColumns({"vec_id": F.lit(7).cast("long"), "embedding": F.array(F.lit(1e300))}), "vec_id", "embedding", 1024, 0)
    mixed = spark.createDataFrame([(1, [1.0], 1, ""), (2, [1.0, 2.0], 1, "")], SCHEMA)
    with pytest.raises((PythonException, ValueError), match="different lengths"):
        whitening.blocks_of(mixed, "vec_id", "embedding", 1024, 0)
