"""Embedding whitening against a dense eigendecomposition."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from lakeframe.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(4)


def dense(vectors, most=32):
    """x-vectors, deviations, eigenvalues and whitened rows with numpy alone."""
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    values, vectors_ = values[::-1][:most], vectors_[:, ::-1][:, :most]
    return [sum((n * int(v) - int(t)) ** 2 for v, t in zip(r, s)) for r in x], values, centred @ vectors_ / np.sqrt(values), (centred ** 2).sum() / n


def test_whitening_equals_a_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    data = (rng.normal(size=(400, 40)) * np.linspace(0.1, 3, 40)).astype(np.float32)
    out = whitening.whiten(table(spark, [(i, v.tolist()) for i, v in enumerate(data)])).toPandas().sort_values(["vec_id", "component"])
    deviation, values, z, trace = dense(data)
    assert out.component.tolist() == list(range(1, 33)) * 400 and set(out.n) == {400}
    got = out.whitened.to_numpy().reshape(400, 32)
    assert np.abs(got - z * np.sign((got * z).sum(axis=0))).max() < 1e-9
    assert out.deviation.to_numpy().reshape(400, 32)[:, 5].tolist() == deviation
    np.testing.assert_allclose(out.explained.to_numpy()[:32], values / trace, rtol=1e-10)
    assert out.identity_error.nunique() == 1 and out.identity_error.iloc[0] < 1e-10


def test_badly_scaled_dimensions_keep_their_components(spark):
    """Plain CholeskyQR on the Gram matrix would lose the small directions."""
    rng = np.random.default_rng(4)
    scale = np.array([1e7, 1e4, 10.0, 1.0])
    data = rng.normal(size=(300, 4)) * scale
    data[:, 1] += data[:, 0]  # nearly parallel
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    model = whitening.fit(whitening.clean_vectors(rows))
    x = np.floor(64 * data).astype(np.int64)
    want = np.linalg.svd((x - x.mean(axis=0)), compute_uv=False) ** 2 / 300
    np.testing.assert_allclose(model.eigenvalues, want, rtol=1e-9)
    assert whitening.identity_error(whitening.clean_vectors(rows), model) < 1e-4
    assert len(model.factors) == whitening.PASSES


def test_rows_that_go_and_rows_that_stay(spark):
    rng = random.Random(1)
    good = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(30)] + [(None, [1.0, 2.0, 3.0, 4.0, 5.0])]
    good += [good[3], good[3]]  # repeated rows
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [math.nan] * 5), (103, [math.inf, 0.0, 0.0, 0.0, 0.0]), (104, []), (105, [1.0] * 4)]
    rows = table(spark, good + bad).withColumnsRenamed({"label": "component"}).selectExpr("*", "'clash' AS whitened", "1 AS x", "2 AS n")
    out = whitening.whiten(rows).toPandas()
    assert len(out) == 33 * 5 and set(out.n) == {33}
    assert sorted(out.vec_id.dropna().unique()) == list(range(30)) and (out.vec_id == 3).sum() == 15
    deviation, values, _, trace = dense([v for _, v in good])
    by_id = {int(r.vec_id): r.deviation for r in out.dropna().itertuples()}
    assert all(by_id[i] == d for (i, _), d in zip(good, deviation) if i is not None)
    np.testing.assert_allclose(sorted(out.explained.unique(), reverse=True), values / trace, rtol=1e-10)


def test_rows_without_variation_have_no_component(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for rows in (empty, table(spark, [(1, [1.0, 2.0])]), table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), table(spark, [(1, None)])):
        assert whitening.whiten(rows).collect() == []
    # two equal dimensions and a constant one leave a single direction
    out = whitening.whiten(table(spark, [(i, [float(i), float(i), 7.0]) for i in range(9)])).toPandas()
    assert set(out.component) == {1} and abs(out.explained - 1).max() < 1e-12 and out.identity_error.max() < 1e-9


def test_a_vector_too_large_for_exact_sums_raises(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")).collect()


def test_deviation_is_exact_beyond_64_bits():
    x = np.array([[1_000_000, 5], [1_000_040, 900]], dtype=np.int64)
    n = 10 ** 10
    sums = np.array([1_000_003 * n + 7, 450 * n - 1], dtype=object)
    got = whitening._deviation(x, n, sums)
    assert [int(v) for v in got] == [sum((n * int(v) - int(s)) ** 2 for v, s in zip(r, sums)) for r in x]


def test_shifted_factor_exists_for_singular_matrices():
    g = np.ones((6, 6))
    r = whitening.shifted_cholesky(g, shift=True)
    assert np.allclose(r.T @ r, g, atol=1e-9)
    assert np.allclose(whitening._inverse(r) @ r, np.eye(6))
    upper = np.triu(np.random.default_rng(0).normal(size=(5, 5))) + 5 * np.eye(5)
    assert Fraction(1) == Fraction(round(float((whitening._inverse(upper) @ upper)[2, 2]), 9))
