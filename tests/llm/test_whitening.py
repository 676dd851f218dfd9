"""Spectrum slicing against plain linear algebra."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tierwatch.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, whitened int, n int"


def symmetric(values, seed):
    turned, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))
    made = turned @ np.diag(values) @ turned.T
    return (made + made.T) / 2


@given(st.lists(st.integers(-6, 6), min_size=1, max_size=9), st.integers(0, 50))
@settings(max_examples=200, deadline=None)
def test_inertia_counts_signs(values, seed):
    matrix = symmetric([v + 0.25 for v in values], seed)
    assert w.inertia(matrix)[:2] == (sum(v >= 0 for v in values), sum(v < 0 for v in values))


def test_inertia_of_matrices_without_diagonal():
    assert w.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == (1, 1, 0)
    assert w.inertia(np.zeros((3, 3))) == (0, 0, 3)


@given(st.lists(st.sampled_from([0.0, 1e-3, 1.0, 1.0 + 1e-9, 2.0, 2.5, 1e4]), min_size=1, max_size=12), st.integers(0, 50))
@settings(max_examples=150, deadline=None)
def test_leading_eigenvalues(values, seed):
    matrix = symmetric(values, seed)
    found, vectors = w.leading(matrix, 5)
    wanted = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    assert np.allclose(found, wanted[:len(found)], atol=1e-12 * max(1.0, max(values)), rtol=1e-12)
    assert np.allclose(vectors @ vectors.T, np.eye(len(found)), atol=1e-13)
    assert np.allclose(matrix @ vectors.T, vectors.T * found, atol=1e-12 * max(1.0, max(values)))
    assert len(found) == min(5, sum(v > 1e-9 * max(values) for v in values)) or min(v for v in values if v) < 1e-6 * max(values)


def plain(vectors):
    x = np.floor(np.array(vectors, np.float32).astype(float) * 1024).astype(int) + 100_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    return [int(d) for d in ((n * x - s) ** 2).sum(axis=1)], centred @ turned[:, ::-1] / np.sqrt(np.maximum(values[::-1], 1e-300)), values[::-1]


def check(rows, vectors):
    deviations, whitened, values = plain(vectors)
    k = min(8, vectors.shape[1])
    assert len(rows) == len(vectors) * k and {r.n for r in rows} == {len(vectors)}
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(by) == len(rows)
    for c in range(1, k + 1):
        got = np.array([by[i, c].whitened for i in range(len(vectors))])
        sign = np.sign(got @ whitened[:, c - 1])
        assert np.allclose(got, sign * whitened[:, c - 1], atol=1e-7)
        assert abs(by[0, c].explained - values[c - 1] / values.sum()) < 1e-12 and by[0, c].identity_error < 1e-9
    assert [by[i, 1].deviation for i in range(len(vectors))] == deviations


def test_rows_against_plain_algebra(spark):
    random = np.random.default_rng(5)
    vectors = (random.normal(size=(300, 11)) @ random.normal(size=(11, 11)) * 0.1).astype(np.float32)
    bad = [(1000, None), (1001, []), (1002, [1.0, None] + [0.0] * 9), (1003, [float("nan")] * 11), (1004, [float("inf")] * 11), (1005, [1.0, 2.0])]
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(vectors)] + [(i, v, 1, 2) for i, v in bad]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    fitted = w.fit(table)
    made = w.whiten(table, fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("c", "whitened"))
    error = w.identity_error(table, fitted)
    found = made.select("vec_id", (F.col("c") + 1).alias("component"), "whitened", "deviation").collect()

    class Row:
        def __init__(self, r):
            self.vec_id, self.component, self.whitened, self.deviation = r
            self.n, self.explained, self.identity_error = fitted.moments.n, fitted.values[self.component - 1] / fitted.trace, error

    check([Row(r) for r in found], vectors)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.5, -0.5]) for i in range(9)]])
def test_no_spread_gives_no_rows(spark, rows):
    table = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)
    fitted = w.fit(table)
    assert len(fitted.values) == 0 and w.whiten(table, fitted).count() == 0 and w.identity_error(table, fitted) == 0.0


def test_fewer_components_null_ids_repeats_and_wide_entries(spark):
    rows = [(None, [float(i % 3), 2.0 * (i % 3), 3e38]) for i in range(6)] + [(7, [0.0, 0.0, -3e38])] * 3
    table = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)
    fitted = w.fit(table)
    found = w.whiten(table, fitted).collect()
    assert len(found) == 9 and fitted.moments.n == 9 and 1 <= len(fitted.values) <= 2
    assert all(r.deviation is None for r in found) and all(np.isfinite(r.whitened).all() for r in found)


def test_query_on_a_given_table(spark):
    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r.vec_id for r in given] == list(range(len(given)))
    check(w.op12_whitening(spark, sf).collect(), np.array([r.embedding for r in given], np.float32))
