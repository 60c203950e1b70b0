"""Trend uncertainty, spline reports, ordered reports and the portable split."""

from __future__ import annotations

import datetime as dt
import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from causeway.operators import forecast as T
from causeway.operators.additive import ItsAdditive
from causeway.operators.regress import Regression, SplineModel
from causeway.operators.tables import hash_split
from causeway.operators.trend import trend_draws, trend_interval
from causeway.sources.report import build_report, write_report


def test_draws_have_the_planned_moments(spark):
    """Variance of the trend after n steps of h: the sum over steps of p 2 b^2 (the change's time to the end)^2."""
    times = spark.range(1, 41).select((F.col("id") * 7.0).alias("_day"))
    rate, size = 0.02, 0.5
    rows = trend_draws(times, 0.0, rate, size, 3.0, 4000, 7).toPandas()
    last = rows[rows._day == 280.0]
    p, var = 1 - np.exp(-rate * 7), 2 * size**2
    ends = 7.0 * np.arange(39, -1, -1)
    want = sum(p * var * (e**2 + e * 7 + 49 / 3) for e in ends)
    assert last.trend.var() == pytest.approx(want, rel=0.12) and abs(last.trend.mean()) < 4 * np.sqrt(want / 4000)
    assert (last.draw - last.trend).std() == pytest.approx(3.0, rel=0.05)
    first = rows[rows._day == 7.0]
    assert (first.trend != 0).mean() == pytest.approx(p, abs=0.02)
    again = trend_draws(times.repartition(5), 0.0, rate, size, 3.0, 4000, 7).toPandas()
    assert np.allclose(again.sort_values(["_day", "replicate"]).draw, rows.sort_values(["_day", "replicate"]).draw)


def test_interval_widens_and_covers(spark):
    """Planted paths whose slope changes at the stated rate: about 95 % of them stay inside, at every horizon."""
    rng = np.random.default_rng(3)
    rate, size, noise, steps = 0.01, 1.0, 5.0, 60
    band = trend_interval(spark.range(1, steps + 1).select((F.col("id") * 7.0).alias("_day")), 0.0, rate, size, noise, 0.95, 2000, 1).orderBy("_day").toPandas()
    width = (band._above - band._below).to_numpy()
    assert width[0] < width[20] < width[59] and width[0] == pytest.approx(2 * 1.96 * noise, rel=0.15)
    inside = np.zeros(steps)
    for _ in range(800):
        days = np.sort(rng.uniform(0, 7 * steps, rng.poisson(rate * 7 * steps)))
        change = rng.laplace(0, size, len(days))
        t = 7.0 * np.arange(1, steps + 1)
        path = (np.maximum(t[:, None] - days[None, :], 0) * change).sum(1) + rng.normal(0, noise, steps)
        inside += (path > band._below) & (path < band._above)
    assert (inside[[0, 10, 30, 59]] / 800 > 0.92).all() and (inside[[0, 10, 30, 59]] / 800 < 0.985).all()


def test_forecasts_of_both_models_widen(spark):
    rng = np.random.default_rng(5)
    n = 300
    slope = np.cumsum(np.where(rng.random(n) < 0.03, rng.laplace(0, 1.0, n), 0.0))
    y = 500 + np.cumsum(slope) + rng.normal(0, 1, n)
    days = [dt.date(2015, 1, 5) + dt.timedelta(weeks=i) for i in range(n)]
    series = spark.createDataFrame(pd.DataFrame({"time": days, "value": y}))
    fit = T.CalendarForecast(order=2).fit(series)
    plain, wide = (f(fit, series, 30).orderBy("time").toPandas() for f in (T.forecast, T.forecast_with_trend))
    assert np.allclose(plain["mean"], wide["mean"]) and wide.columns.tolist() == plain.columns.tolist()
    spread = (wide.upper - wide.lower).to_numpy()
    assert spread[29] > 1.5 * spread[0] and spread[29] > (plain.upper - plain.lower).iloc[29]
    none = T.CalendarForecast(order=2, knots=()).fit(series)
    assert T.forecast_with_trend(none, series, 3).count() == 3

    rows = spark.createDataFrame(pd.DataFrame({"time": np.arange(n), "value": y}))
    study = ItsAdditive("time", [200]).fit(rows, "value")
    ahead = study.forecast(rows.select("time").unionByName(spark.range(n, n + 60).select(F.col("id").alias("time")))).orderBy("time").toPandas()
    spread = (ahead.upper - ahead.lower).to_numpy()
    assert np.isfinite(spread).all() and spread[-1] > 1.3 * spread[n] and np.allclose(spread[:n], spread[0], rtol=0.5)


# ---------------------------------------------------------------- splines


@pytest.fixture(scope="module")
def curved(spark):
    rng = np.random.default_rng(6)
    x1, x2 = rng.uniform(0, 10, 600), rng.uniform(1, 20, 600)
    pdf = pd.DataFrame({"x1": x1, "x2": x2, "y": 50 + 5 * np.sin(x1) + 0.05 * (x2 - 4) ** 2 + rng.normal(0, 0.2, 600)})
    df = spark.createDataFrame(pdf)
    return df, pdf, SplineModel.fit(df, ["x1", "x2"], "y", lam=0.1)


def test_spline_effects_equal_the_slope_of_predictions(spark, curved):
    df, pdf, model = curved
    for x in (0.7, 3.3, 9.1):
        at = spark.createDataFrame([(x - 1e-5, 5.0), (x + 1e-5, 5.0)], "x1 double, x2 double")
        low, high = (r.prediction for r in model.predict(at).orderBy("x1").collect())
        assert model.marginal_effect("x1", x) == pytest.approx((high - low) / 2e-5, rel=1e-4, abs=1e-5)
        assert model.marginal_effect("x1", x) == pytest.approx(5 * np.cos(x), abs=1.2)
        (r,) = spark.range(1).select(model.effect_expression("x1", F.lit(x)).alias("e")).collect()
        assert r.e == pytest.approx(model.marginal_effect("x1", x), rel=1e-9)
    assert model.marginal_effect("x2") == model.marginal_effect("x2", pdf.x2.mean())


def test_spline_elasticity_and_responsiveness(spark, curved):
    _, pdf, model = curved
    assert model.elasticity("x2", 12.0, 60.0) == pytest.approx(model.marginal_effect("x2") * 12 / 60, rel=0.5)
    (r,) = model.responsiveness(spark, "x2", 5.0).collect()
    change = model.marginal_effect("x2") * 0.05 * pdf.x2.mean()
    assert (r.base_x_mean, r.base_y_mean) == (pytest.approx(pdf.x2.mean()), pytest.approx(pdf.y.mean()))
    assert (r.absolute_y_effect, r.percentage_y_effect) == (pytest.approx(change), pytest.approx(100 * change / pdf.y.mean()))
    with pytest.raises(ValueError, match="undefined"):
        model.elasticity("x2", 1.0, 0.0)
    with pytest.raises(ValueError, match="not in the model"):
        model.responsiveness(spark, "x9")


def test_variable_report_of_both_kinds(spark, curved):
    df, _, model = curved
    linear = Regression.fit(df, ["x1", "x2"], "y")
    for m in (model, linear):
        rows = {r.variable: r for r in m.variable_report(spark, 50).collect()}
        assert set(rows) == {"x1", "x2"}
        assert all(rows[v].marginal_effect == pytest.approx(m.marginal_effect(v)) for v in rows)
    assert rows["x1"].model == "linear" and model.variable_report(spark, 20).filter("model = 'spline'").count() == 2


# ---------------------------------------------------------------- report and split


def test_report_is_in_order_whatever_its_size(spark, tmp_path):
    table = spark.range(3000).select(F.format_string("k%05d", F.lit(2999) - F.col("id")).alias("k"), (F.col("id") / 4).alias("v")).repartition(9)
    lines = build_report(spark, "Title", [("Small", spark.createDataFrame([(2, "b"), (1, "a")], "n int, t string"), ["n"]), ("Large", table, ["k"])])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_report(lines, str(tmp_path / "r"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "r").glob("part-*"))
    text = [line for f in files for line in f.read_text().split("\n")[:-1]]
    assert len(files) > 1 and text[0] == "# Title"
    start = text.index("## Small")
    assert text[start + 2:start + 6] == ["| n | t |", "| --- | --- |", "| 1 | a |", "| 2 | b |"]
    body = [t for t in text if t.startswith("| k0")]
    assert len(body) == 3000 and body == sorted(body)


def test_split_by_a_portable_hash(spark):
    rows = hash_split(spark.range(4000), F.col("id"), 25, 20).collect()
    for r in rows[:500]:
        assert r.is_test == (int(hashlib.md5(f"{r.id}:20".encode()).hexdigest()[:8], 16) % 100 < 25)
    assert 0.22 < sum(r.is_test for r in rows) / 4000 < 0.28
    other = hash_split(spark.range(4000), F.col("id"), 25, 21).collect()
    assert [r.is_test for r in other] != [r.is_test for r in rows]
