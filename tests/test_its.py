"""Interrupted time series against direct numpy fits of the full design."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from causeway.operators import its
from causeway.operators.additive import ItsAdditive
from causeway.operators.arima import ItsArima
from causeway.operators.its import SegmentedFit, SegmentedOls
from causeway.session import scratch_path


def series(seed=42, points=(40, 80, 120), levels=(5, -3, 8), slopes=(0.2, -0.1, 0.4), n=150, sd=2.0):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    y = 0.3 * t + rng.normal(0, sd, n)
    for i, p in enumerate(points):
        end = points[i + 1] if i + 1 < len(points) else n
        inside = (t >= p) & (t < end)
        y += inside * (levels[i] + slopes[i] * (t - p))
    return pd.DataFrame({"time": t, "value": y})


def numpy_design(pdf, points, group=None):
    pdf = pdf.sort_values(([group] if group else []) + ["time"]).reset_index(drop=True)
    key = pdf[group] if group else pd.Series(0, index=pdf.index)
    out = pd.DataFrame({"const": 1.0, "t": pdf.time - pdf.groupby(key).time.transform("min") + 1})
    for i, p in enumerate(points):
        end = points[i + 1] if i + 1 < len(points) else np.inf
        d = ((pdf.time >= p) & (pdf.time < end)).astype(float)
        out[f"D_{i + 1}"] = d
        out[f"timedelta_{i + 1}"] = d.groupby(key).cumsum() * d
    return pdf, out


@pytest.fixture(scope="module")
def panel(spark):
    """Groups with different starts, gaps in time, a numeric and a text covariate."""
    rng = np.random.default_rng(11)
    parts = []
    for g, start in (("a", 0), ("b", 5), ("c", 2)):
        t = np.array([v for v in range(start, 60) if v % 17 != 3])
        x = rng.normal(size=len(t))
        kind = rng.choice(["u", "v", "w"], len(t))
        y = 10 + 0.2 * t + 4 * (t >= 30) + 0.5 * np.maximum(t - 29, 0) * (t >= 30) + 2 * x + (kind == "w") + rng.normal(0, 0.5, len(t))
        parts.append(pd.DataFrame({"g": g, "time": t, "value": y, "x": x, "kind": kind}))
    pdf = pd.concat(parts)
    return spark.createDataFrame(pdf.sample(frac=1.0, random_state=1)), pdf


def test_fit_equals_numpy_with_gaps_groups_and_covariates(spark, panel):
    df, pdf = panel
    fit = SegmentedOls("time", [30], "g").fit(df.repartition(6), "value", ["x", "kind"])
    rows, x = numpy_design(pdf, [30], "g")
    x["x"] = rows.x
    x["kind_v"], x["kind_w"] = (rows.kind == "v") * 1.0, (rows.kind == "w") * 1.0
    x = x[list(fit.terms)].to_numpy(float)
    b, *_ = np.linalg.lstsq(x, rows.value, rcond=None)
    assert np.allclose(fit.coef, b, rtol=1e-7)
    e = rows.value.to_numpy() - x @ b
    u = x * e[:, None]
    meat = u.T @ u
    for _, at in rows.groupby("g").indices.items():
        for lag in range(1, 4):
            c = u[at][lag:].T @ u[at][:-lag]
            meat += (1 - lag / 4) * (c + c.T)
    inv = np.linalg.inv(x.T @ x)
    assert np.allclose(np.array(fit.covariance), inv @ meat @ inv, rtol=1e-6)
    got = fit.predict(interval=True).select("g", "time", "mean", "mean_se", "obs_ci_upper").toPandas().sort_values(["g", "time"])
    assert np.allclose(got["mean"], x @ b, atol=1e-8)
    v = inv @ meat @ inv
    se = np.sqrt(np.einsum("ij,jk,ik->i", x, v, x))
    assert np.allclose(got.mean_se, se, rtol=1e-6)
    s2 = e @ e / (len(e) - x.shape[1])
    assert np.allclose(got.obs_ci_upper, x @ b + 1.959963984540054 * np.sqrt(se**2 + s2), rtol=1e-8)


def test_design_matches_rows_and_duplicate_times_share_counts(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (2, 2.0), (4, 1.0)], "time long, value double")
    out = its.design(df, "time", [2], bucketed=False).orderBy("time", "value").collect()
    assert [(r.t, r.D_1, r.timedelta_1, r.const) for r in out] == [(1, 0, 0, 1), (2, 1, 2, 1), (2, 1, 2, 1), (4, 1, 3, 1)]


def test_points_are_sorted_and_parameters_recovered(spark):
    pdf = series(sd=0.01)
    fit = SegmentedOls("time", [120, 40, 80]).fit(spark.createDataFrame(pdf), "value")
    c = fit.coefficients
    assert fit.points == (40, 80, 120)
    assert c["t"] == pytest.approx(0.3, abs=1e-3)
    assert c["timedelta_1"] == pytest.approx(0.2, abs=5e-3)
    assert c["D_1"] + c["timedelta_1"] == pytest.approx(5.0, abs=0.05)
    table = fit.intervention_effects(spark).orderBy("intervention", "effect").collect()
    assert [(r.intervention, r.effect) for r in table] == [(i, k) for i in (1, 2, 3) for k in ("level", "trend")]


def test_effect_table_labels_and_counterfactual(spark):
    pdf = series()
    fit = SegmentedOls("time", [40, 80, 120]).fit(spark.createDataFrame(pdf), "value", cov_type="nonrobust")
    table = {r.Period: r for r in fit.effects().collect()}
    assert set(table) == {"Pre-intervention", "Intervention_D_1", "Intervention_D_2", "Intervention_D_3"}
    slope, start = np.polyfit(pdf.time[:40], pdf.value[:40], 1)
    late = pdf[pdf.time >= 120]
    assert table["Intervention_D_3"].Counterfactual_mean == pytest.approx((start + slope * late.time).mean())
    assert table["Pre-intervention"].Effect_mean == pytest.approx(0.0, abs=1e-8)
    plot = fit.plot_frame().orderBy("time").collect()
    assert len(plot) == 150 and plot[0].phase == "Pre-intervention"
    assert all(r.counterfactual_lower < r.counterfactual < r.counterfactual_upper for r in plot)


def test_grouped_effects_equal_one_fit_per_group(spark, panel):
    df, pdf = panel
    got = {(r.g, r.Period): r for r in its.effects_per_group(df, "time", [30], "value", "g").collect()}
    for g, part in pdf.groupby("g"):
        rows, x = numpy_design(part, [30])
        b, *_ = np.linalg.lstsq(x.to_numpy(float), rows.value, rcond=None)
        post = (rows.time >= 30).to_numpy()
        cf = (x[["const", "t"]].to_numpy(float) @ b[:2])[post]
        assert got[(g, "Intervention_D_1")].Effect_mean == pytest.approx((rows.value[post] - cf).mean(), rel=1e-7)


def test_saved_model_predicts_the_same_on_new_rows(spark, panel):
    df, pdf = panel
    fit = SegmentedOls("time", [30], "g").fit(df, "value", ["x", "kind"])
    path = scratch_path(spark, "model")
    fit.save(spark, path)
    back = SegmentedFit.load(spark, path)
    assert back.coefficients == fit.coefficients and back.encoder == fit.encoder
    late = df.filter("time >= 30").withColumn("kind", F.when(F.col("kind") == "u", "unseen").otherwise(F.col("kind")))
    a = fit.predict(late).orderBy("g", "time").select("mean").toPandas()["mean"]
    b = back.predict(late).orderBy("g", "time").select("mean").toPandas()["mean"]
    assert np.array_equal(a, b)
    # the time origin is the one stored at fit, not the minimum of the new rows
    own = fit.predict().filter("time >= 30").orderBy("g", "time").select("mean").toPandas()["mean"]
    assert np.allclose(a, own, atol=1e-9)
    # rows that start inside a period go on from the count of the fit, and so do later times
    for model in (fit, back):
        inside = model.predict(late.filter("time >= 41")).orderBy("g", "time").select("mean").toPandas()["mean"]
        whole = fit.predict().filter("time >= 41").orderBy("g", "time").select("mean").toPandas()["mean"]
        assert np.allclose(inside, whole, atol=1e-9)
    last = df.agg(F.max("time")).first()[0]
    ahead = df.filter(F.col("time") == last).withColumn("time", F.lit(last + 1).cast(df.schema["time"].dataType))
    both = fit.predict(df.unionByName(ahead)).filter(F.col("time") > last).orderBy("g").select("mean").toPandas()["mean"]
    assert np.allclose(fit.predict(ahead).orderBy("g").select("mean").toPandas()["mean"], both, atol=1e-9)
    with pytest.raises(ValueError, match="pass the rows"):
        back.predict()


def test_validation_errors(spark):
    df = spark.createDataFrame(series(n=50, points=(40,), levels=(1,), slopes=(0,)))
    with pytest.raises(ValueError, match="not found"):
        SegmentedOls("when", [10]).fit(df, "value")
    with pytest.raises(ValueError, match="not found"):
        SegmentedOls("time", [10], "g").fit(df, "value")
    with pytest.raises(ValueError, match="not found"):
        SegmentedOls("time", [10]).fit(df, "value", ["z"])
    with pytest.raises(ValueError, match="outside"):
        SegmentedOls("time", [99]).fit(df, "value")
    with pytest.raises(ValueError, match="cov_type"):
        SegmentedOls("time", [10]).fit(df, "value", cov_type="HC9")
    with pytest.raises(ValueError, match="10 are needed"):
        SegmentedOls("time", [5]).placebo_test(df, "value")
    with pytest.raises(TypeError):
        SegmentedOls("time", [10]).window_sensitivity(df, "value", bogus=1)


def refit(pdf, point):
    rows, x = numpy_design(pdf, [point])
    b, *_ = np.linalg.lstsq(x.to_numpy(float), rows.value, rcond=None)
    post = (rows.time >= point).to_numpy()
    return (rows.value[post] - x[["const", "t"]].to_numpy(float)[post] @ b[:2]).mean()


def test_placebo_and_sensitivity_equal_refits(spark):
    pdf = series()
    df = spark.createDataFrame(pdf).repartition(4)
    study = SegmentedOls("time", [40, 80, 120])
    r = study.placebo_test(df, "value").first()
    want = [refit(pdf[pdf.time < 40], p) for p in (9.75, 19.5, 29.25)]
    assert r.placebo_points == [9.75, 19.5, 29.25]
    assert np.allclose(r.placebo_effects, want, rtol=1e-7)
    assert r.mean_placebo_effect == pytest.approx(np.mean(want))
    assert r.std_placebo_effect == pytest.approx(np.std(want))
    t = np.mean(want) / (np.std(want, ddof=1) / np.sqrt(3))
    assert r.p_value == pytest.approx(1 - abs(t) / np.sqrt(2 + t * t))
    assert r.is_valid == (r.p_value > 0.05) and r.n_placebo_tests == 3
    per = study.placebo_per_intervention(df, "value").collect()
    assert len(per) == 9 and {x.real_intervention_index for x in per} == {0, 1, 2}
    one = next(x for x in per if x.real_intervention_index == 1 and x.placebo_point == 40 + 39 / 2)
    assert one.placebo_effect == pytest.approx(refit(pdf[(pdf.time >= 40) & (pdf.time < 80)], 59.5))
    sens = study.window_sensitivity(df, "value").collect()
    assert len(sens) == 15
    s = next(x for x in sens if (x.intervention_point, x.pre_window, x.post_window) == (80.0, 24, 12))
    assert s.effect_mean == pytest.approx(refit(pdf[(pdf.time >= 56) & (pdf.time <= 92)], 80))


def test_short_intervals_are_left_out(spark):
    df = spark.createDataFrame(series(points=(40,), levels=(1,), slopes=(0,), n=60))
    per = SegmentedOls("time", [40, 45]).placebo_per_intervention(df, "value").collect()
    assert {r.real_intervention_index for r in per} == {0}
    assert SegmentedOls("time", [40]).window_sensitivity(df, "value", [(3, 3)]).count() == 0


# ---------------------------------------------------------------- autoregressive errors


@pytest.fixture(scope="module")
def ar_panel(spark):
    rng = np.random.default_rng(21)
    parts = []
    for g in ("a", "b"):
        n = 400
        e = rng.normal(0, 1, n)
        noise = np.zeros(n)
        for i in range(1, n):
            noise[i] = 0.6 * noise[i - 1] + e[i]
        t = np.arange(n)
        y = 20 + noise + (t >= 200) * (8 + 0.05 * (t - 199))
        parts.append(pd.DataFrame({"g": g, "time": t, "value": y}))
    return spark.createDataFrame(pd.concat(parts))


def test_arima_recovers_level_and_trend(ar_panel):
    fit = ItsArima("time", [200], "g").fit(ar_panel, "value", (1, 0, 0))
    got = {(r.g, r.term): r for r in fit.coefficient_table().collect()}
    for g in ("a", "b"):
        assert got[(g, "D_1")].coef == pytest.approx(8.0, abs=2.5)
        assert got[(g, "timedelta_1")].coef == pytest.approx(0.05, abs=0.02)
        assert got[(g, "const")].coef == pytest.approx(20.0, abs=1.0)
    phi = {r.g: r.coef[0] for r in fit.arma_fits.collect()}
    assert all(p == pytest.approx(0.6, abs=0.12) for p in phi.values())
    rows = fit.predict().filter("mean is not null").toPandas()
    assert (rows.value - rows["mean"]).std() == pytest.approx(1.0, abs=0.1)
    inside = ((rows.value > rows.lower) & (rows.value < rows.upper)).mean()
    assert 0.92 < inside < 0.98
    effects = {(r.g, r.Period): r.Effect_mean for r in fit.effects().collect()}
    assert effects[("a", "Intervention_D_1")] == pytest.approx(13.0, abs=1.5)
    assert effects[("a", "Pre-intervention")] == pytest.approx(0.0, abs=0.3)


def test_arima_with_differencing_runs_and_keeps_the_step(spark):
    rng = np.random.default_rng(3)
    y = np.cumsum(rng.normal(0, 0.5, 200)) + 10 * (np.arange(200) >= 100)
    df = spark.createDataFrame(pd.DataFrame({"time": np.arange(200), "value": y}))
    fit = ItsArima("time", [100]).fit(df, "value", (1, 1, 1))
    coef = {r.term: r.coef for r in fit.coefficient_table().collect()}
    assert coef["D_1"] == pytest.approx(10.0, abs=2.0)


def test_order_search_uses_pre_rows_only(spark, ar_panel):
    study = ItsArima("time", [200], "g")
    grid = {"d": (0,), "s": (0,), "p": (0, 1, 2), "q": (0, 1)}
    scores = study.search(ar_panel, "value", grid)
    shifted = ar_panel.withColumn("value", F.when(F.col("time") >= 200, -999.0).otherwise(F.col("value")))
    again = study.search(shifted, "value", grid)
    key = ["g", "p", "q"]
    a = scores.orderBy(*key).select("aic").toPandas().aic
    b = again.orderBy(*key).select("aic").toPandas().aic
    assert len(a) == 12 and np.allclose(a, b)
    order, _ = study.best_order(scores)
    assert order[0] >= 1
    with pytest.raises(ValueError, match="10 are needed"):
        ItsArima("time", [3]).search(ar_panel.filter("g = 'a'"), "value")
    with pytest.raises(ValueError, match="unknown grid"):
        study.search(ar_panel, "value", {"r": (1,)})


# ---------------------------------------------------------------- additive


def test_additive_model_recovers_a_step(spark):
    pdf = series(points=(100,), levels=(20,), slopes=(0.0,), n=200, sd=0.5)
    df = spark.createDataFrame(pdf)
    fit = ItsAdditive("time", [100]).fit(df, "value")
    rows = fit.predict(components=True).toPandas()
    assert np.abs(rows.value - rows["mean"]).mean() < 1.0
    parts = rows[["trend", "changepoints", "weekly", "regressors"]].sum(axis=1)
    assert np.allclose((rows["mean"] - parts).std(), 0.0, atol=1e-8)
    effects = {r.Period: r.Effect_mean for r in fit.effects().collect()}
    assert effects["Intervention_D_1"] == pytest.approx(20.0, abs=4.0)
    assert effects["Pre-intervention"] == pytest.approx(0.0, abs=0.5)


def test_additive_search_ignores_post_rows(spark):
    pdf = series(points=(100,), levels=(20,), slopes=(0.0,), n=200, sd=0.5).assign(value=lambda d: d.value + 50)
    study = ItsAdditive("time", [100])
    grids = {"scales": (0.01, 0.5), "counts": (5, 15)}
    one = study.search(spark.createDataFrame(pdf), "value", **grids).orderBy("changepoint_scale", "n_changepoints").toPandas()
    two = study.search(spark.createDataFrame(pdf.assign(value=np.where(pdf.time >= 100, 1e6, pdf.value))), "value", **grids)
    two = two.orderBy("changepoint_scale", "n_changepoints").toPandas()
    assert len(one) == 4 and np.allclose(one.mape, two.mape)
    assert (one.mape < 0.1).all()
    with pytest.raises(ValueError, match="10 are needed"):
        ItsAdditive("time", [5]).search(spark.createDataFrame(pdf), "value")


def test_placebo_of_every_model(spark):
    # level data: the autoregressive model has no trend regressor, so a trend would count as an effect
    pdf = series(points=(100,), levels=(20,), slopes=(0.0,), n=140, sd=0.5)
    df = spark.createDataFrame(pdf.assign(value=pdf.value - 0.3 * pdf.time + 50))
    for kind in (SegmentedOls, ItsArima, ItsAdditive):
        r = kind("time", [100]).placebo_test(df, "value").first()
        assert r.n_placebo_tests == 3 and abs(r.mean_placebo_effect) < 1.0


def test_arima_forecast_and_storage(spark):
    rng = np.random.default_rng(30)
    n, e = 500, rng.normal(0, 1, 500)
    noise = np.zeros(n)
    for i in range(1, n):
        noise[i] = 0.7 * noise[i - 1] + e[i]
    t = np.arange(n)
    df = spark.createDataFrame(pd.DataFrame({"time": t, "value": 30 + noise + 6 * (t >= 250)}))
    fit = ItsArima("time", [250]).fit(df, "value", (1, 0, 0))
    future = spark.createDataFrame([(int(n + h),) for h in range(6)], "time long")
    got = fit.forecast(future).orderBy("time").toPandas()
    coef = {r.term: r.coef for r in fit.coefficient_table().collect()}
    phi = fit.arma_fits.collect()[0].coef[0]
    base = [coef["const"] + coef["D_1"] + coef["timedelta_1"] * (250 + h) for h in range(1, 7)]
    last = 30 + noise[-1] + 6 - (coef["const"] + coef["D_1"] + coef["timedelta_1"] * 250)
    assert np.allclose(got["mean"], [b + phi ** h * last for h, b in enumerate(base, 1)], rtol=1e-9)
    half = (got.upper - got.lower).to_numpy() / 2
    want = np.sqrt(np.cumsum(phi ** (2 * np.arange(6))))
    assert np.allclose(half / half[0], want, rtol=1e-9)
    path = scratch_path(spark, "arima")
    fit.save(path)
    from causeway.operators.arima import ArimaFit
    back = ArimaFit.load(spark, path)
    assert np.array_equal(back.forecast(future).orderBy("time").toPandas()["mean"], got["mean"])
    with pytest.raises(ValueError, match="holds no rows"):
        back.predict()


def test_arima_forecast_continues_a_difference(spark):
    y = 5.0 + 2.0 * np.arange(120) + np.tile([0.0, 3.0, -1.0, 1.0], 30)
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(pd.DataFrame({"time": np.arange(120), "value": y + rng.normal(0, 1e-3, 120)}))
    fit = ItsArima("time", [60]).fit(df, "value", (1, 0, 0), (0, 1, 0, 4))
    future = spark.createDataFrame([(120 + h,) for h in range(4)], "time long")
    got = fit.forecast(future).orderBy("time").toPandas()["mean"]
    # every seasonal difference is 8, carried by the autoregression without a constant
    assert np.allclose(got, y[-4:] + 8.0, atol=0.5)


def test_additive_storage_round_trip(spark):
    from causeway.operators.additive import AdditiveFit

    df = spark.createDataFrame(series(points=(100,), levels=(20,), slopes=(0.0,), n=140, sd=0.5))
    fit = ItsAdditive("time", [100]).fit(df, "value")
    path = scratch_path(spark, "additive")
    fit.save(spark, path)
    back = AdditiveFit.load(spark, path)
    a = fit.predict().orderBy("time").toPandas()
    b = back.predict(df).orderBy("time").toPandas()
    assert np.allclose(a["mean"], b["mean"], atol=1e-9) and np.allclose(a.upper, b.upper, atol=1e-9)
    late = back.predict(df.filter("time >= 120")).orderBy("time").toPandas()  # starts inside a period
    assert np.allclose(late["mean"], a["mean"][a.time >= 120], atol=1e-9)
    with pytest.raises(ValueError, match="pass the rows"):
        back.predict()


def test_additive_candidate_alone_and_among_others(spark):
    """The effect of a fake point doesn't depend on the other points asked."""
    df = spark.createDataFrame(series(points=(100,), levels=(20,), slopes=(0.0,), n=140, sd=0.5)).filter("time < 100")
    model = ItsAdditive("time", [100])

    def ask(points):
        effects = model._candidates(df, "value", model._frame(spark, [(0, 100, p) for p in points]), ())
        return {points[r.candidate]: r.effect for r in effects.collect()}

    assert ask([45])[45] == pytest.approx(ask([30, 45, 60])[45], rel=1e-9)  # sums in another order
