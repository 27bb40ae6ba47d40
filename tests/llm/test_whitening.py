"""Whitening against a plain eigenvalue decomposition; the solver on hard matrices; odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from termfold.llm import whitening as W

RNG = np.random.default_rng(5)


def turned(values):
    n = len(values)
    left, right = (np.linalg.qr(RNG.standard_normal((n, n)))[0] for _ in range(2))
    return left @ np.diag(values) @ right


HARD = {
    "random": RNG.standard_normal((40, 40)), "one": np.array([[3.0]]), "two": RNG.standard_normal((2, 2)), "identity": np.eye(20),
    "zero": np.zeros((6, 6)), "repeated": np.diag([5.0, 5, 5, 4, 3, 3, 3, 3, 3, 3]), "repeated_turned": turned([3.0] * 10 + [2.0] * 10 + [0.0] * 5),
    "graded": turned(10.0 ** -np.arange(25)), "close": turned(1 + 1e-9 * np.arange(30)), "clusters": turned([9 + 1e-13, 9, 9 - 1e-7, 1, 1 - 1e-14, 0.5]),
    "rank": np.vstack([RNG.standard_normal((3, 12)), np.zeros((9, 12))]),
}


@pytest.mark.parametrize("name", HARD)
def test_solver(name):
    r = HARD[name]
    values, axes = W.components(r, 8)
    true = np.linalg.svd(r)[1][:8]
    top = max(true[0], 1e-300)
    assert np.abs(np.sqrt(values) - true).max() <= 1e-13 * top
    fine = np.count_nonzero(values)
    assert fine == np.count_nonzero(true > len(r) * W.EPS * true[0])
    assert np.abs(axes[:, :fine].T @ axes[:, :fine] - np.eye(fine)).max(initial=0) < 1e-11
    assert np.abs(r.T @ (r @ axes[:, :fine]) - axes[:, :fine] * values[:fine]).max(initial=0) <= 1e-13 * top**2


def test_small_values_are_accurate():
    """dqds keeps digits of the least value of a bidiagonal matrix, where R'R would have lost them all."""
    n = 30
    got = W.squared_singular_values(np.full(n, 1.0), np.full(n - 1, 10.0))
    inverse = np.triu(np.array([[(-10.0) ** (j - i) for j in range(n)] for i in range(n)]))
    assert got[-1] ** 0.5 == pytest.approx(1 / np.linalg.norm(inverse, 2), rel=1e-12)


def plain(ids, vectors, wanted=8):
    x = np.floor(np.array(vectors, float) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-e)[:wanted]
    return ((n * x - s) ** 2).sum(axis=1), c @ v[:, order] / np.sqrt(e[order]), e[order] / e.sum()


def test_given_table(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    p = W.op13_whitening(spark, sf_dir).toPandas().sort_values(["vec_id", "component"])
    deviation, white, explained = plain([r.vec_id for r in given], [r.embedding for r in given])
    shape = (len(given), 8)
    assert p.vec_id.tolist() == [r.vec_id for r in given for _ in range(8)] and set(p.n) == {len(given)}
    assert (p.deviation.to_numpy().reshape(shape) == deviation[:, None]).all()
    w = p.whitened.to_numpy().reshape(shape)
    assert np.abs(w * np.sign((w * white).sum(axis=0)) - white).max() < 1e-9
    assert np.abs(p.explained.to_numpy().reshape(shape) / explained - 1).max() < 1e-10
    assert p.identity_error.nunique() == 1 and p.identity_error.iloc[0] < 1e-9
    assert np.abs(w.T @ w / len(given) - np.eye(8)).max() < 1e-9


def test_triangles_of_many_tasks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(W, "FAN_IN", 3)
    rows = W.staged(W.usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).repartition(20))
    n, sums = W.fitted(rows)
    r = W.reduced(rows, n, sums)
    x = np.array([t.x for t in rows.collect()])
    c = x - sums / n
    assert np.allclose(r.T @ r, c.T @ c, rtol=1e-10, atol=1e-6) and np.abs(np.tril(r, -1)).max() == 0


SCHEMA = "vec_id long, embedding array<float>, label int"
ROWS = [(1, [0.5, 1.0, -1.0], 0), (1, [0.5, 1.0, -1.0], 0), (None, [2.0, 0.25, 1.0], 1), (3, None, 0), (4, [], 0), (5, [1.0, None, 2.0], 0),
        (6, [float("nan"), 1.0, 1.0], 0), (7, [float("inf"), 1.0, 1.0], 0), (8, [0.0, 0.0, 0.0], 0), (9, [-3.0, 2.0, 0.125], 0)]


def test_odd_tables(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted((tuple(r) for r in W.whitened(df).collect()), key=repr)
    assert len(got) == 5 * 3 and {r[0] for r in got} == {1, None, 8, 9}
    clash = df.withColumns({c: F.lit("clash") for c in ("x", "w", "n", "component", "deviation", "whitened")})
    assert sorted((tuple(r) for r in W.whitened(clash).collect()), key=repr) == got
    assert W.whitened(df.where("false")).collect() == [] == W.whitened(df.where("vec_id = 3")).collect()


def test_without_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    assert {(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in W.whitened(same).collect()} == {
        (1, 0, None, 0.0, 0.0), (2, 0, None, 0.0, 0.0)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id long, embedding array<double>")
    got = W.whitened(line).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in got) and got[0].identity_error < 1e-12


def test_errors_say_what_is_wrong(spark):
    with pytest.raises(ValueError, match="from 2 to 3 entries"):
        W.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>"))
    with pytest.raises(Exception, match="too large for exact sums, vec_id 7"):
        W.whitened(spark.createDataFrame([(7, [1e30, 2.0])], "vec_id long, embedding array<double>"))
