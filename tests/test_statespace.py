"""Exact ARMA likelihood against the density of the whole vector, and blocks against one filter."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from causeway.operators import statespace
from causeway.operators.arima import ORDER_COLUMNS, ItsArima
from causeway.operators.its import SegmentedOls
from causeway.operators.statespace import ArmaFilter, damped, exact_fits, innovations, maximise, polynomials, profile


def autocovariance(phi, theta, n, terms=6000):
    psi = np.zeros(terms)
    for j in range(terms):
        psi[j] = (1.0 if j == 0 else 0.0) + (theta[j - 1] if 0 < j <= len(theta) else 0.0) + sum(c * psi[j - i - 1] for i, c in enumerate(phi) if j > i)
    return np.array([psi[:terms - k] @ psi[k:] for k in range(n)])


def density(y, x, phi, theta):
    """Concentrated log-likelihood, variance and coefficients from the full covariance matrix."""
    n = len(y)
    gamma = autocovariance(phi, theta, n)
    v = gamma[np.abs(np.arange(n)[:, None] - np.arange(n)[None, :])]
    inverse = np.linalg.inv(v)
    beta = np.linalg.solve(x.T @ inverse @ x, x.T @ inverse @ y) if x.shape[1] else np.zeros(0)
    r = y - x @ beta
    variance = r @ inverse @ r / n
    return -0.5 * n * (np.log(2 * np.pi * variance) + 1) - 0.5 * np.linalg.slogdet(v)[1], variance, beta


def simulated(phi, theta, n, seed):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 300)
    w = np.zeros(n + 300)
    for t in range(len(w)):
        w[t] = e[t] + sum(c * w[t - i - 1] for i, c in enumerate(phi) if t > i) + sum(c * e[t - j - 1] for j, c in enumerate(theta) if t > j)
    return w[300:]


SEASONAL = [0.5] + [0.0] * 10 + [0.3]
CASES = [([0.6], [0.4]), ([0.5, -0.3], []), ([], [0.8, 0.2]), ([], []), (SEASONAL, []), ([0.9], [0.0] * 11 + [-0.5]), ([], [1.0])]


@pytest.mark.parametrize("phi,theta", CASES)
def test_likelihood_equals_the_density(phi, theta):
    rng = np.random.default_rng(3)
    n = 45
    x = np.column_stack([np.ones(n), rng.normal(size=n)])
    y = x @ [3.0, 2.0] + simulated(phi, theta, n, 4)
    arma = ArmaFilter(phi, theta, n)
    v, _ = arma.run(np.column_stack([y, x]), 0, np.zeros((arma.size, 3)))
    loglik, variance, beta, _ = profile(n, *arma.sums(v, 0))
    want = density(y, x, phi, theta)
    assert loglik == pytest.approx(want[0], abs=1e-6) and variance == pytest.approx(want[1], rel=1e-7) and beta == pytest.approx(want[2], abs=1e-6)


def frames(spark, n=230, phi=(0.6,), theta=(0.4,)):
    rng = np.random.default_rng(6)
    rows = []
    for g in "ab":
        x = rng.normal(size=n)
        y = 2 * x + 1 + simulated(phi, theta, n, ord(g))
        rows += [(g, t, float(y[t]), 1.0, float(x[t])) for t in range(n)]
    return spark.createDataFrame(rows, "g string, _pos bigint, y double, c double, x double").repartition(5)


@pytest.mark.parametrize("block", [4096, 50, 7])
def test_blocks_equal_one_filter(spark, monkeypatch, block):
    series = frames(spark)
    params = spark.createDataFrame([(g, i, list(map(float, p)), list(map(float, q))) for g in "ab" for i, (p, q) in enumerate(CASES)],
                                   "g string, candidate bigint, phi array<double>, theta array<double>")
    monkeypatch.setattr(statespace, "BLOCK", block)
    found = exact_fits(series, params, ["g"], ["y", "c", "x"]).collect()
    assert len(found) == 2 * len(CASES)
    rows = series.toPandas().sort_values("_pos")
    for r in found:
        own = rows[rows.g == r.g]
        arma = ArmaFilter(*CASES[r.candidate], len(own))
        v, _ = arma.run(own[["y", "c", "x"]].to_numpy(), 0, np.zeros((arma.size, 3)))
        loglik, variance, beta, _ = profile(len(own), *arma.sums(v, 0))
        assert (r.n, r.loglik, r.variance) == (len(own), pytest.approx(loglik, abs=1e-6), pytest.approx(variance, rel=1e-8))
        assert r.beta == pytest.approx(beta, abs=1e-7)
    one = innovations(series, params.filter("candidate = 0"), ["g"], ["y", "c", "x"]).toPandas().sort_values(["g", "_pos"])
    arma = ArmaFilter(*CASES[0], 230)
    want, _ = arma.run(rows[rows.g == "b"][["y", "c", "x"]].to_numpy(), 0, np.zeros((arma.size, 3)))
    assert np.allclose(np.stack(one[one.g == "b"]["shock"].to_list()), want, atol=1e-9)


def test_search_finds_the_maximum(spark):
    series = frames(spark, 400)
    start = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [0.3, -0.2])], "g string, point array<double>")
    best = maximise(series, start, ["g"], ["y", "c", "x"], [1], [1])
    found = {r.g: r for r in exact_fits(series, best, ["g"], ["y", "c", "x"]).collect()}
    rows = series.toPandas().sort_values("_pos")
    for r in best.collect():
        assert r.phi[0] == pytest.approx(0.6, abs=0.15) and r.theta[0] == pytest.approx(0.4, abs=0.2)
        own = rows[rows.g == r.g][["y", "c", "x"]].to_numpy()

        def at(phi, theta, own=own):
            arma = ArmaFilter([phi], [theta], len(own))
            return profile(len(own), *arma.sums(arma.run(own, 0, np.zeros((arma.size, 3)))[0], 0))[0]

        around = max(at(r.phi[0] + a, r.theta[0] + b) for a in (-0.02, 0, 0.02) for b in (-0.02, 0, 0.02))
        assert around <= found[r.g].loglik + 0.02


def test_polynomials_stay_inside_the_unit_circle():
    assert damped(np.array([0.3, 0.2])).tolist() == [0.3, 0.2]
    for poly in ([1.4], [0.5, 0.9], [0.0] * 11 + [1.2]):
        out = damped(np.array(poly))
        companion = np.eye(len(out), k=-1)
        companion[0] = out
        assert np.abs(np.linalg.eigvals(companion)).max() == pytest.approx(0.98, abs=1e-6)
    phi, theta = polynomials(np.array([0.4, 0.1, -0.3]), [1, 12], [2])
    assert phi.tolist() == [0.4] + [0.0] * 10 + [0.1] and theta.tolist() == [0.0, -0.3]


# ---------------------------------------------------------------- study


@pytest.fixture(scope="module")
def seasonal(spark):
    rng = np.random.default_rng(9)
    n = 180
    x = rng.normal(size=n)
    y = 50 + 4 * x + 3 * simulated([0.0] * 11 + [0.85], [], n, 10)
    return spark.createDataFrame(pd.DataFrame({"time": np.arange(n), "value": y, "x": x})).repartition(3)


def test_seasonal_orders_and_covariates_are_scored(spark, seasonal):
    study = ItsArima("time", [150])
    grid = {"p": (0, 1), "d": (0,), "q": (0, 1), "P": (0, 1, 2), "D": (0, 1), "Q": (0, 1), "s": (0, 12, 30)}
    plain, helped = (study.search(seasonal, "value", grid, c).toPandas() for c in ((), ("x",)))
    assert len(plain) == len(helped) == 4 + 2 * 2 * 4 * 6 and set(plain.s) == {0, 12, 30}
    level = plain[(plain.seasonal_d == 0)]
    assert (level.n_obs == 150).all() and (plain[plain.seasonal_d == 1].n_obs < 150).all()
    top = helped[helped.seasonal_d == 0].sort_values("aic").iloc[0]
    assert top.s == 12 and top.seasonal_p >= 1
    assert helped.sort_values("aic").iloc[0].s == 12
    assert helped.aic.min() < plain.aic.min() - 0.5
    (order, season) = study.best_order(study.search(seasonal, "value", grid, ["x"]))
    assert season[3] == 12
    # the score is the exact AIC at the reported order's coefficients
    white = helped[(helped[ORDER_COLUMNS] == 0).all(axis=1)].iloc[0]
    pdf = seasonal.toPandas().sort_values("time").head(150)
    z = np.column_stack([np.ones(150), pdf.x])
    rss = np.linalg.lstsq(z, pdf.value, rcond=None)[1][0]
    assert white.aic == pytest.approx(np.log(2 * np.pi * rss / 150) + 1 + 2 * 3 / 150, rel=1e-9)


def test_exact_study(spark):
    """Intervention effects under strong autocorrelation; white errors give ordinary least squares."""
    rng = np.random.default_rng(12)
    n = 200
    t = np.arange(n)
    y = 10 + 8 * (t >= 120) + simulated([0.7], [], n, 13)
    df = spark.createDataFrame(pd.DataFrame({"time": t, "value": y, "z": rng.normal(size=n)}))
    fit = ItsArima("time", [120]).fit_exact(df, "value", (1, 0, 0), covariates=["z"])
    table = {r.term: r for r in fit.coefficient_table().collect()}
    assert abs(table["D_1"].coef - 8) < 3 * table["D_1"].std_error and abs(table["z"].statistic) < 4
    (phi,) = fit.params.collect()
    assert phi.phi[0] == pytest.approx(0.7, abs=0.12)
    loose = ItsArima("time", [120]).fit(df, "value", (1, 0, 0), covariates=["z"])
    assert {r.Period for r in fit.effects().collect()} == {r.Period for r in loose.effects().collect()}
    (post,) = [r for r in fit.effects().collect() if r.Period != "Pre-intervention"]
    assert post.Effect_mean == pytest.approx(post.Actual_mean - post.Counterfactual_mean)
    white = ItsArima("time", [120]).fit_exact(df, "value", (0, 0, 0))
    d = (t >= 120).astype(float)
    x = np.column_stack([d, np.where(d > 0, t - 119, 0), np.ones(n)])
    b, *_ = np.linalg.lstsq(x, y, rcond=None)
    assert [r.coef for r in white.coefficient_table().orderBy("ord").collect()] == pytest.approx(b, abs=1e-7)


def test_seven_interventions_and_wide_groups(spark):
    rng = np.random.default_rng(14)
    n = 400
    points = [50, 100, 150, 200, 250, 300, 350]
    t = np.arange(n)
    rows = pd.DataFrame([{"g": g, "time": i, "value": 5 + sum(i >= p for p in points) + rng.normal()} for g in "ab" for i in t])
    fit = ItsArima("time", points, "g").fit(spark.createDataFrame(rows), "value", (1, 0, 0))
    table = fit.coefficient_table().toPandas()
    assert len(table) == 2 * 15 and table[table.term == "D_7"].coef.between(5.5, 8.5).all()


def test_rows_that_share_a_time_are_refused(spark):
    df = spark.createDataFrame([("a", i // 2, float(i)) for i in range(80)], "g string, time int, value double")
    for run in (lambda: ItsArima("time", [20], "g").fit(df, "value"), lambda: ItsArima("time", [20], "g").search(df, "value", {"s": (0,)})):
        with pytest.raises(ValueError, match="one row per"):
            run()
    assert SegmentedOls("time", [20], "g").fit(df, "value").effects().count() == 2
