"""Whitening against an exact covariance in fractions and a dense solve."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tripflow.llm import whitening as M
from tripflow.llm.queries import op11_whitening


def fractions(x):
    n = len(x)
    mean = [Fraction(sum(c), n) for c in zip(*x, strict=True)]
    centred = [[v - m for v, m in zip(row, mean, strict=True)] for row in x]
    d = len(mean)
    return mean, [
        [sum(r[i] * r[j] for r in centred) / n for j in range(d)] for i in range(d)
    ], centred


def scaled(vectors):
    return [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]


def frame(spark, rows, more=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<float>{more}")


def test_query_against_fractions(spark, sf):
    rows = [r for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    x = scaled([r.embedding for r in rows])
    n, d = len(x), len(x[0])
    sums = [sum(c) for c in zip(*x, strict=True)]
    squares = np.array([[n * v - s for v, s in zip(r, sums, strict=True)] for r in x], dtype=object)
    covariance = (squares.T @ squares / n**3).astype(float)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    expected = (squares.astype(float) / n) @ vectors / np.sqrt(values)

    got = op11_whitening(spark, sf).collect()
    assert len(got) == 8 * n
    place = {r.vec_id: i for i, r in enumerate(rows)}
    found, deviation = np.empty((n, 8)), {}
    for r in got:
        found[place[r.vec_id], r.component - 1] = r.whitened
        deviation[r.vec_id] = r.deviation
        assert r.n == n and r.identity_error < 1e-10
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(covariance), rel=1e-10)
    signs = np.sign((found * expected).sum(axis=0))
    assert np.abs(found * signs - expected).max() < 1e-9
    assert deviation == {
        r.vec_id: int((y * y).sum()) for r, y in zip(rows, squares, strict=True)
    }
    assert d == 64


@pytest.mark.parametrize("size", [0.3, 4e4, 1e8])
def test_covariance_is_exact_at_any_size(spark, size):
    draw = np.random.default_rng(3)
    vectors = (draw.standard_normal((40, 5)) * size + 2 * size).astype(np.float32)
    fit = M.fit_whitening(
        M.whole_vectors(frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]))
    )
    mean, covariance, _ = fractions(scaled(vectors.tolist()))
    exact = np.array([[float(v) for v in row] for row in covariance])
    assert (fit.covariance == exact).all()
    assert [Fraction(int(r), fit.n) + int(c) for r, c in zip(fit.rest, fit.centre, strict=True)] == mean


def test_squares_of_wide_numbers():
    z = np.array([[2**42 - 5, -(2**41) - 3], [-7, 2**21]])
    assert M._squares(z).tolist() == [(2**42 - 5) ** 2 + 49, (2**41 + 3) ** 2 + 2**42]


def test_deviations_beyond_a_long(spark):
    vectors = [(i, [float(i * 10**6), 1.0]) for i in range(200)]
    rows = M.whitened_components(frame(spark, vectors)).collect()
    x = scaled([v for _, v in vectors])
    sums = [sum(c) for c in zip(*x, strict=True)]
    exact = [sum((200 * v - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
    assert max(exact) > 2**63
    assert {r.vec_id: int(r.deviation_exact) for r in rows} == dict(enumerate(exact))
    assert {r.component for r in rows} == {1}  # the second dimension does not vary


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (None, [0.0, -1.0, 2.0]), (4, None), (5, []),
        (6, [1.0, None, 2.0]), (7, [nan, 1.0, 1.0]), (8, [1.0, inf, 1.0]), (9, [1.0, -inf, 1.0]),
        (10, [3.0, 0.1, -4.0]), (11, [0.0, 0.0, 0.0]),
    ]
    clash = (7, "x", 1.5, [3])
    more = ", component long, x string, whitened double, deviation array<int>"
    got = M.whitened_components(frame(spark, [r + clash for r in rows], more)).collect()
    whole = [r for r in rows if r[0] in (1, None, 10, 11)]
    assert sorted({r.vec_id for r in got}, key=repr) == sorted({r[0] for r in whole}, key=repr)
    assert len(got) == 3 * len(whole) and {r.n for r in got} == {len(whole)}
    assert max(r.identity_error for r in got) < 1e-10
    twice = sorted((r.component, r.whitened) for r in got if r.vec_id == 1)
    assert twice[::2] == twice[1::2]


def test_no_vector_and_no_variance(spark):
    columns = M.whitened_components(frame(spark, [(1, [1.0, 2.0]), (2, [0.0, 4.0])])).columns
    for rows in ([], [(1, None)], [(1, [2.0, 2.0]), (2, [2.0, 2.0])], [(1, [5.0, 1.0])]):
        found = M.whitened_components(frame(spark, rows))
        assert found.columns == columns and found.count() == 0


def test_lengths_that_differ_are_an_error(spark):
    table = frame(spark, [(1, [1.0, 2.0]), (2, [1.0])])
    for parts in (1, 2):
        with pytest.raises(Exception, match="vectors of 1 and of 2|vectors of 2 and of 1"):
            M.whitened_components(table.repartition(parts, "vec_id"))
