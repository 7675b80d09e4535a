"""Whitening against numpy's own eigenvectors and exact integer sums."""

import math

import numpy as np
import pytest

from roadbook.llm import queries, whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def _matrices():
    r = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 24, 64):
        b = r.standard_normal((n, n))
        q = np.linalg.qr(b)[0]
        yield from (b @ b.T, b + b.T, np.eye(n) * 3, np.zeros((n, n)), np.diag(np.arange(n) * 1.0))
        yield q @ np.diag(10.0 ** -np.clip(np.arange(n), 0, 12)) @ q.T
        yield q @ np.diag(np.repeat(np.arange(1, n + 1), 3)[:n] * 1.0) @ q.T  # eigenvalues that occur thrice


def test_eigen_is_that_of_numpy():
    for a in _matrices():
        values, vectors = whitening.eigen(a)
        scale = max(np.abs(a).max(), 1e-300)
        assert np.allclose(values, np.linalg.eigvalsh((a + a.T) / 2)[::-1], rtol=0, atol=1e-13 * len(a) * scale)
        assert np.allclose(vectors.T @ vectors, np.eye(len(a)), rtol=0, atol=1e-13)
        assert np.allclose((a + a.T) / 2 @ vectors, vectors * values, rtol=0, atol=1e-13 * len(a) * scale)


def test_polar_factor_is_unitary_and_positive():
    a = np.random.default_rng(1).standard_normal((20, 20))
    a = a + a.T
    u = whitening.polar(a)
    assert np.allclose(u @ u, np.eye(20), atol=1e-13)
    assert np.linalg.eigvalsh((u @ a + (u @ a).T) / 2).min() > 0


def _brute(rows, top=8):
    """From (id, vector) rows: by id and component, all columns, by other means than the operator's."""
    held = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in held]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    centred = np.array([[float(c * n - s) / n for c, s in zip(v, sums, strict=True)] for v in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:top], vectors[:, ::-1][:, :top]
    return [i for i, _ in held], deviation, centred @ vectors / np.sqrt(values), values / np.trace(covariance), n


def _compare(found, rows):
    ids, deviation, white, shares, n = _brute(rows)
    assert len(found) == white.size
    by = {(r.vec_id, r.component): r for r in found}
    for c in range(white.shape[1]):
        got = np.array([by[i, c + 1].whitened for i in ids])
        sign = np.sign(got @ white[:, c])
        assert np.allclose(got, sign * white[:, c], rtol=0, atol=1e-8)
        assert np.isclose(by[ids[0], c + 1].explained, shares[c], rtol=1e-10)
    assert [by[i, 1].deviation for i in ids] == deviation
    assert {r.n for r in found} == {n}
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-10


def test_query_is_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    _compare(queries.op11_whitening(spark, sf_dir).collect(), rows)


def test_odd_vectors(spark):
    rows = [
        (1, [0.5, -0.25, 1.0]), (2, None), (3, [0.1, None, 0.0]), (4, [float("nan"), 0.0, 0.0]), (5, [float("inf"), 0.0, 1.0]),
        (6, [-0.5, 0.125, 0.0]), (7, [3.0, 2.0, 1.0]), (8, [0.0, 0.0, 0.3]), (9, [float("-inf"), 0.0, 1.0]), (10, [0.5, -0.25, 1.0]),
    ]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).selectExpr("*", "'clash' AS n", "1 AS x", "2 AS whitened", "3 AS id")
    found = whitening.whiten(frame).withColumnRenamed("id", "vec_id").collect()
    _compare(found, rows)
    assert {r.vec_id for r in found} == {1, 6, 7, 8, 10}


def test_null_ids_and_repeated_rows(spark):
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.0, 1.0]), (None, [1.0, -1.0])]
    found = whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], VECTORS)).collect()
    assert len(found) == 8 and sum(r.id is None for r in found) == 4


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, None)], [(1, [])]])
def test_no_variance_gives_no_rows(spark, rows):
    frame = spark.createDataFrame([(*r, 0) for r in rows], VECTORS)
    found = whitening.whiten(frame)
    assert found.columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == 0


def test_components_without_variance_are_left_out(spark):
    frame = spark.createDataFrame([(i, [i / 10, i / 5, 0.0], 0) for i in range(10)], VECTORS)
    found = whitening.whiten(frame).collect()
    assert {r.component for r in found} <= {1, 2}
    assert max(r.identity_error for r in found) < 1e-8


def test_unequal_lengths_and_huge_entries_are_refused(spark):
    with pytest.raises(ValueError, match="one length"):
        whitening.whiten(spark.createDataFrame([(1, [0.5], 0), (2, [0.5, 1.0], 0)], VECTORS))
    with pytest.raises(Exception, match="beyond 2"):
        whitening.whiten(spark.createDataFrame([(1, [1e30], 0), (2, [0.5], 0)], VECTORS)).collect()


def test_deviation_is_exact_for_large_numbers(spark):
    rows = [(i, [float(4000 * (i % 7) - 9000), float(i)], 0) for i in range(50)]
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS)).withColumnRenamed("id", "vec_id").collect()
    _compare(found, [r[:2] for r in rows])
