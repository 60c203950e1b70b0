"""Fits against independent numpy calculations, recovery of known parameters, errors."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from causeway.operators import gram as G
from causeway.operators import regress as M
from causeway.operators.logistic import compare_penalties, fit_logistic
from causeway.operators.regress import Regression, SplineModel


def frame(spark, **columns):
    names = list(columns)
    rows = [tuple(float(v) for v in r) for r in zip(*columns.values())]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


@pytest.fixture(scope="module")
def two(spark):
    rng = np.random.default_rng(5)
    x1, x2 = rng.uniform(1, 10, 400), rng.normal(1000, 2, 400)
    y = 5 + 2 * x1 + 1.5 * x2 + rng.normal(0, 1, 400)
    return frame(spark, y=y, x1=x1, x2=x2), np.column_stack([np.ones(400), x1, x2]), y


def ols(x, y):
    b, *_ = np.linalg.lstsq(x, y, rcond=None)
    e = y - x @ b
    s2 = e @ e / (len(y) - np.linalg.matrix_rank(x))
    return b, s2 * np.linalg.pinv(x.T @ x), e


def test_ols_matches_numpy(spark, two):
    df, x, y = two
    m = Regression.fit(df.repartition(5), ["x1", "x2"], "y")
    b, v, e = ols(x, y)
    assert np.allclose(m.solution.coef, b, rtol=1e-8)
    assert np.allclose(np.diag(m.solution.covariance), np.diag(v), rtol=1e-6)
    assert m.r_squared == pytest.approx(1 - e @ e / ((y - y.mean()) @ (y - y.mean())), rel=1e-9)
    table = {r.term: r for r in m.coefficient_table(spark).collect()}
    assert table["x1"].statistic == pytest.approx(b[1] / np.sqrt(v[1, 1]), rel=1e-6)
    assert table["x1"].p_value < 1e-10
    assert m.predict_one(x1=3.0, x2=1001.0) == pytest.approx(b @ [1, 3, 1001])
    assert "x1" in m.summary()


def test_row_order_and_partitions_do_not_matter(two):
    df, *_ = two
    a = Regression.fit(df.coalesce(1).orderBy("y"), ["x1", "x2"], "y").solution.coef
    b = Regression.fit(df.repartition(9), ["x1", "x2"], "y").solution.coef
    assert np.allclose(a, b, rtol=1e-9)


def test_collinear_design_gives_minimum_norm(spark):
    x1 = np.linspace(1, 10, 100)
    rng = np.random.default_rng(1)
    y = 5 + 2 * x1 + 3 * x1 + rng.normal(0, 1, 100)
    m = Regression.fit(frame(spark, y=y, x1=x1, x2=2 * x1), ["x1", "x2"], "y")
    x = np.column_stack([np.ones(100), x1, 2 * x1])
    assert m.solution.rank == 2
    assert np.allclose(m.solution.coef, np.linalg.pinv(x) @ y, rtol=1e-6)


def test_constant_feature_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 1.0, 7.0), (2.0, 3.0, 7.0), (4.0, 5.0, 7.0), (None, 1.0, 7.0), (3.0, None, 7.0)],
                               "y double, x double, c double")
    m = Regression.fit(df, ["x", "c"], "y")
    assert (m.solution.n, m.solution.rank) == (3, 2)
    x = np.array([[1, 1, 7], [1, 3, 7], [1, 5, 7]])
    assert np.allclose(m.solution.coef, np.linalg.pinv(x) @ [1, 2, 4], atol=1e-9)


def test_log_models_recover_parameters(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(1, 100, 500)
    power = frame(spark, x=x, y=100 * x**0.7)
    m = Regression.fit(power, ["x"], "y", "doublelog")
    assert m.slopes["x"] == pytest.approx(0.7, abs=1e-9)
    assert m.predict_one(x=16.0) == pytest.approx(100 * 16**0.7)
    assert m.marginal_effect("x", 16.0) == pytest.approx(70 * 16**-0.3)
    assert m.elasticity("x", 16.0, m.predict_one(x=16.0)) == pytest.approx(0.7)
    semi = Regression.fit(frame(spark, x=x, y=3 + 5 * np.log(x)), ["x"], "y", "semilog")
    assert semi.slopes["x"] == pytest.approx(5.0)
    assert semi.marginal_effect("x", 10.0) == pytest.approx(0.5)
    s = m.saturation(spark, "x", 100).first()
    assert s.diminishing_returns and s.saturation_x is None  # 100^-0.3 is still 25% of the top effect
    with pytest.raises(ValueError, match="positive"):
        Regression.fit(frame(spark, x=[1.0, 0.0, 2.0], y=[1.0, 2.0, 3.0]), ["x"], "y", "semilog")
    with pytest.raises(ValueError, match="y = 0"):
        m.elasticity("x", 1.0, 0.0)
    with pytest.raises(ValueError, match="not in the model"):
        m.marginal_effect("z")
    with pytest.raises(ValueError, match="not found"):
        Regression.fit(power, ["nope"], "y")
    with pytest.raises(ValueError, match="no rows"):
        Regression.fit(power.filter("x < 0"), ["x"], "y")


def test_saturation_threshold_at_first_small_effect(spark):
    x = np.linspace(1, 1000, 400)
    m = Regression.fit(frame(spark, x=x, y=50 * x**0.1), ["x"], "y", "doublelog")
    got = m.saturation(spark, "x", 100).first()
    grid = np.linspace(1, 1000, 100)
    effect = 5 * grid**-0.9
    assert got.saturation_x == pytest.approx(grid[np.argmax(effect <= 0.01 * effect.max())])
    linear = Regression.fit(frame(spark, x=x, y=2 * x), ["x"], "y").saturation(spark, "x").first()
    assert linear.saturation_x is None and linear.max_abs_marginal_effect == pytest.approx(2.0)


def test_grouped_fit_and_apply(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=300)
    g = np.arange(300) % 3
    y = g + (g + 1) * x
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(g, x, y)], "g int, x double, y double")
    fits = G.fit_by(df, ["x"], "y", ["g"])
    got = {r.g: r.coef for r in fits.collect()}
    for k in range(3):
        assert np.allclose(got[k], [k, k + 1], atol=1e-9)
    worst = G.apply_fit(df, fits, ["x"], ["g"], "f").agg(F.max(F.abs(F.col("f") - F.col("y")))).first()[0]
    assert worst < 1e-9


def test_wide_gram_equals_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3))
    df = spark.createDataFrame([(i % 2, *map(float, r)) for i, r in enumerate(x)], "g int, a double, b double, c double")
    got = G.collect_gram(G.wide_gram(df.repartition(4), ["a", "b", "c"], lambda v: v), 4)
    z = np.column_stack([np.ones(500), x])
    assert np.allclose(got, z.T @ z)
    per = {r.g: np.asarray(r.entries) for r in G.pack_by(G.wide_gram(df, ["a", "b", "c"], lambda v: v, ["g"]), ["g"]).collect()}
    assert np.allclose(G.unpack_gram(per[1], 4), z[1::2].T @ z[1::2])


def test_many_features_use_the_wide_path(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(100, 1, size=(300, 16))
    y = x @ np.arange(16) + rng.normal(size=300)
    df = frame(spark, **{f"x{i}": x[:, i] for i in range(16)}, y=y)
    m = Regression.fit(df, [f"x{i}" for i in range(16)], "y")
    b, *_ = ols(np.column_stack([np.ones(300), x]), y)
    assert np.allclose(m.solution.coef[1:], b[1:], rtol=1e-6)


def test_newey_west_against_direct_sum(spark):
    rng = np.random.default_rng(9)
    rows, blocks = [], []
    for g in range(3):
        t = np.arange(40.0)
        y = 2 + 0.5 * t + np.convolve(rng.normal(size=43), [1, 0.6, 0.3, 0.1], "valid")
        blocks.append((t, y))
        rows += [(g, float(a), float(b)) for a, b in zip(t, y)]
    df = spark.createDataFrame(rows, "g int, t double, y double")
    x = np.column_stack([np.ones(120), np.concatenate([t for t, _ in blocks])])
    y = np.concatenate([v for _, v in blocks])
    b, _, e = ols(x, y)
    u = (x * e[:, None]).reshape(3, 40, 2)
    meat = np.einsum("gti,gtj->ij", u, u)
    for lag in range(1, 4):
        g = np.einsum("gti,gtj->ij", u[:, lag:], u[:, :-lag])
        meat += (1 - lag / 4) * (g + g.T)
    inv = np.linalg.inv(x.T @ x)
    want = np.sqrt(np.diag(inv @ meat @ inv))
    got = M.robust_table(df.repartition(5), ["t"], "y", "t", ["g"], 3).orderBy("ord").collect()
    assert np.allclose([r.std_error for r in got], want, rtol=1e-9)


def test_spline_model_against_numpy(spark):
    rng = np.random.default_rng(7)
    x1, x2 = rng.uniform(0, 6, 800), rng.uniform(0, 20, 800)
    y = 50 + np.sin(x1) + np.exp(-0.1 * x2) + rng.normal(0, 0.1, 800)
    df = frame(spark, x1=x1, x2=x2, y=y)
    m = SplineModel.fit(df, ["x1", "x2"], "y", lam=0.6)
    basis = [M.spline_basis(v, v.min(), v.max(), 20) for v in (x1, x2)]
    assert np.allclose(basis[0].sum(axis=1), 1.0)
    scale = y.std()
    z = np.column_stack([np.ones(800), *basis])
    d = np.diff(np.eye(20), n=2, axis=0)
    p = np.zeros((41, 41))
    p[1:, 1:] = np.kron(np.eye(2), 0.6 * d.T @ d + 1e-6 * np.eye(20))
    fitted = z @ np.linalg.solve(z.T @ z + p, z.T @ (y - y.mean()) / scale) * scale + y.mean()
    got = m.predict(df.withColumn("k", F.monotonically_increasing_id())).orderBy("k").select("prediction").toPandas().prediction
    assert np.allclose(got, fitted, atol=1e-6)
    assert m.r_squared == pytest.approx(1 - ((y - fitted) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-8)
    assert m.r_squared > 0.95
    pd_rows = m.partial_dependence(spark, "x1", 25).toPandas()
    centred = pd_rows.partial - pd_rows.partial.mean()
    assert np.abs(centred - (np.sin(pd_rows.x) - np.sin(pd_rows.x).mean())).max() < 0.15
    at = spark.range(1).select(m.effect_expression("x1", F.lit(3.0)).alias("e")).first().e
    assert at == pytest.approx(np.cos(3.0), abs=0.25)
    assert m.saturation(spark, "x1").first().sign_change_x == pytest.approx(np.pi / 2, abs=0.3)


def test_logistic_gradient_is_zero(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(400, 2))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -2.0])))).astype(float)
    df = frame(spark, a=x[:, 0], b=x[:, 1], y=y)
    for c in (None, 1.0):
        w = np.array(list(fit_logistic(df, ["a", "b"], "y", c).values()))
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - y) + (0 if c is None else w / c)
        assert np.abs(slope).max() < 1e-3
    table = {r.features: r for r in compare_penalties(df, ["a", "b"], "y").collect()}
    assert abs(table["a"].l2_default) < abs(table["a"].none)
    assert table["b"].l2_tiny == pytest.approx(table["b"].none, rel=1e-4)


def test_curve_analysis(spark):
    x = np.linspace(1, 100, 200)
    y = 5000 * x**0.4
    df = spark.createDataFrame([(0, float(a), float(b)) for a, b in zip(x, y)], "k int, x double, y double")
    d1 = np.gradient(y, x)
    d2 = np.gradient(d1, x)
    t = M.turning_points(df, ["k"], "x", "y").first()
    assert t.x_min_slope == pytest.approx(x[d1.argmin()])
    assert t.x_min_curvature == pytest.approx(x[d2.argmin()])
    assert t.x_slope_p10 == pytest.approx(x[np.where(d1 <= np.percentile(d1, 10))[0][0]])
    assert t.x_curvature_p5 == pytest.approx(x[np.where(d2 > np.percentile(d2, 5))[0][0]])
    s = M.stop_point(df, ["k"], "x", "y", 1.0, 100.0, 50.0).first()
    assert s.x_stop == pytest.approx(x[np.where(d1 - 100 <= 50)[0][0]])
    never = M.stop_point(df, ["k"], "x", "y", 1.0, 0.0, -1.0).first()
    assert never.x_stop is None and never.net_at_stop is None


def test_spline_effects_at_and_beyond_the_ends(spark):
    """On a straight line the slope is the same everywhere and predictions go on along it."""
    x = np.linspace(0, 10, 201)
    m = SplineModel.fit(frame(spark, x=x, y=3 * x + 5), ["x"], "y")
    at = frame(spark, x=np.array([-2.0, 0.0, 0.01, 5.0, 9.99, 10.0, 12.0]))
    got = m.predict(at).withColumn("effect", m.effect_expression("x", F.col("x"))).orderBy("x").toPandas()
    assert got.effect.to_numpy() == pytest.approx(np.full(7, 3.0), abs=1e-3)
    assert got.prediction.to_numpy() == pytest.approx(3 * got.x.to_numpy() + 5, abs=1e-2)
