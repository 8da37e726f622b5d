"""Whitening: rank-one updates against dense decompositions, the operator against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiplog.llm.spectra import Spectrum, updated
from shiplog.llm.whitening import component_rows, whitened

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def scatter(x):
    centred = x - x.mean(axis=0)
    return centred.T @ centred


@pytest.mark.parametrize("case", range(12))
def test_spectra_of_halves_combine_to_that_of_all(case):
    rng = np.random.default_rng(case)
    dim, n = int(rng.integers(1, 40)), int(rng.integers(1, 150))
    x = rng.integers(-1000, 1000, (n, dim)) + 100_000
    if case % 3 == 0:
        x[n // 2 :] = x[0]
    if case % 4 == 0 and dim > 3:
        x[:, 2], x[:, 0] = x[:, 1], 7
    one, two = Spectrum.nothing(dim), Spectrum.nothing(dim)
    for row in x[: n // 2]:
        one.add(row)
    for row in x[n // 2 :]:
        two.add(row)
    one.absorb(two)
    back = one.vectors @ np.diag(one.values) @ one.vectors.T
    assert np.abs(back - scatter(x)).max() <= 1e-11 * max(1, np.abs(scatter(x)).max())
    assert np.abs(one.vectors.T @ one.vectors - np.eye(dim)).max() < 1e-12
    assert one.n == n and (one.sums == x.sum(axis=0)).all()


def test_update_with_close_and_equal_eigenvalues():
    d = np.array([1.0, 1.0, 1.0 + 1e-15, 2.0, 2.0 + 1e-9, 5.0])
    v = np.array([0.3, -0.2, 0.0, 1e-20, 0.7, -1.0])
    values, vectors = updated(d, np.eye(6), v, 2.0)
    assert np.allclose(vectors @ np.diag(values) @ vectors.T, np.diag(d) + 2 * np.outer(v, v), atol=1e-14)
    assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-13


def table(spark, vectors):
    rows = [(i, v, None) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def test_operator_is_numpys(spark):
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(400, 12)) * np.arange(1, 13) / 8).astype(np.float32)
    got = component_rows(whitened(table(spark, x.tolist()).repartition(40))).collect()
    grid = np.floor(1024 * x.astype(float)).astype(np.int64) + 100_000
    n, sums = len(grid), grid.sum(axis=0)
    values, vectors = np.linalg.eigh(scatter(grid.astype(float)) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = (grid - sums / n) @ vectors[:, :8] / np.sqrt(values[:8])
    have = np.zeros((400, 8))
    for r in got:
        have[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == int(((n * grid[r.vec_id] - sums) ** 2).sum())
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-12)
        assert r.identity_error < 1e-12
    assert len(got) == 400 * 8
    assert np.abs(have * np.sign((have * want).sum(axis=0)) - want).max() < 1e-11


def test_broken_and_odd_vectors(spark):
    good = [[0.5, 0.25], [0.5, 0.25], [-0.5, 1.0], [2.0, -1.0]]
    bad = [None, [], [1.0, None], [math.nan, 1.0], [math.inf, 1.0], [1.0], [1.0, 2.0, 3.0]]
    rows = table(spark, good + bad).withColumns({c: F.lit(c) for c in ("key", "vector", "n", "part")})
    got = component_rows(whitened(rows)).collect()
    assert sorted((r.vec_id, r.component) for r in got) == [(i, c) for i in range(4) for c in (1, 2)]
    assert {r.n for r in got} == {4}
    twin = [[r.whitened for r in got if r.vec_id == i] for i in (0, 1)]
    assert twin[0] == twin[1]


def test_no_variance_no_rows_and_null_ids(spark):
    same = spark.createDataFrame([(None, [1.0, 2.0], 1)] * 3, SCHEMA)
    got = component_rows(whitened(same)).collect()
    assert len(got) == 6 and all(r.whitened is None and r.explained == 0 for r in got)
    assert {r.deviation for r in got} == {0} and {r.identity_error for r in got} == {None}
    assert component_rows(whitened(same.limit(0))).count() == 0
    assert component_rows(whitened(table(spark, [None, [math.nan]]))).count() == 0
