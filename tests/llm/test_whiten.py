"""Whitening against numpy on exact fractions."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import whiten


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int, n string")


def plain(vectors):
    """x, exact covariances and sums, by the definition."""
    x = np.floor(1024 * np.asarray(vectors, float)).astype(object) + 100000
    x = np.array([[int(v) for v in row] for row in x], object)
    n, total = len(x), x.sum(axis=0)
    y = n * x - total
    cov = [[float(Fraction(int((y[:, i] * y[:, j]).sum()), n**3)) for j in range(x.shape[1])] for i in range(x.shape[1])]
    return x, y, np.array(cov)


def vectors(n=300, d=12, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) * 9).tolist()


def test_covariances_are_the_exact_ones(spark):
    v = vectors()
    fitted = whiten.fit(whiten.whole_vectors(frame(spark, [(i, x, 1, "a") for i, x in enumerate(v)]).repartition(7)))
    x, _, cov = plain(v)
    assert fitted.n == len(v) and fitted.total == x.sum(axis=0).tolist()
    values = np.linalg.eigvalsh(cov)[::-1]
    np.testing.assert_allclose(fitted.values, values, rtol=1e-9)
    np.testing.assert_allclose(fitted.vectors @ np.diag(fitted.values) @ fitted.vectors.T, cov, rtol=1e-9, atol=1e-6)


def test_pair_squares_give_covariances_to_the_last_bit():
    z = np.array([[3, -1], [0, 5], [-4, 2]])
    off = [-int(s) for s in z.sum(axis=0)]
    got = whiten.covariances(3, off, whiten._pair_squares(z))
    want = np.array([[Fraction(int((z[:, i] * z[:, j]).sum()), 3) - Fraction(int(z[:, i].sum() * z[:, j].sum()), 9) for j in range(2)] for i in range(2)], float)
    assert (got == want).all()


@pytest.mark.parametrize("size", [1, 2**20, 2**35])
def test_sums_of_any_size_are_exact(size):
    z = (np.arange(12).reshape(4, 3) - 7) * size
    want = [sum((int(z[r, i]) + (int(z[r, j]) if j > i else 0)) ** 2 for r in range(4)) for i in range(3) for j in range(i, 3)]
    assert whiten._pair_squares(z) == want
    limbs = whiten._limbs([*want, -5, 0])
    assert [whiten._number(x) for x in (limbs + limbs).tolist()] == [2 * w for w in [*want, -5, 0]]


def test_rows_and_columns(spark):
    v = vectors(80, 10, 3)
    df = frame(spark, [(i, x, 1, "a") for i, x in enumerate(v)])
    got = whiten.whitened(df.withColumn("deviation", F.lit(1))).toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    x, y, cov = plain(v)
    assert len(got) == 80 * 8 and (got.n == 80).all() and got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    values, columns = np.linalg.eigh(cov)
    want = (y.astype(float) / 80) @ columns[:, ::-1][:, :8] / np.sqrt(values[::-1][:8])
    np.testing.assert_allclose(np.abs(w), np.abs(want), rtol=1e-6, atol=1e-9)
    first = got.drop_duplicates("vec_id").set_index("vec_id")
    assert first.deviation.to_dict() == {i: int((row * row).sum()) for i, row in enumerate(y)}
    np.testing.assert_allclose(got[got.vec_id == 0].explained, values[::-1][:8] / values.sum(), rtol=1e-9)


def test_vectors_that_take_no_part(spark):
    good = [[1.0, 2.0], [2.0, 0.5], [0.0, 1.0], [0.0, 1.0]]
    bad = [None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [1e300, 0.0], [1.0, 2.0, 3.0]]
    df = frame(spark, [(i, x, 1, "a") for i, x in enumerate(good + bad)] + [(None, [5.0, 5.0], None, None), (0, good[0], 1, "a")])
    got = whiten.whitened(df).collect()
    assert {r.vec_id for r in got} == {0, 1, 2, 3, None} and len(got) == 12 and {r.n for r in got} == {6}


def test_without_variance_and_without_rows(spark):
    got = whiten.whitened(frame(spark, [(i, [1.0, float(i)], 1, "a") for i in range(5)])).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-9 for r in got)
    alone = whiten.whitened(frame(spark, [(1, [1.0, 2.0], 1, "a")])).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(0, None, None, None)] * 2
    assert whiten.whitened(frame(spark, [])).collect() == []


def test_deviations_beyond_a_long_are_null(spark):
    got = whiten.whitened(frame(spark, [(0, [2.0**45], 1, "a"), (1, [0.0], 1, "a")])).collect()
    assert [r.deviation for r in got] == [None, None] and {round(abs(r.whitened), 9) for r in got} == {1.0}
