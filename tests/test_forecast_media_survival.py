from __future__ import annotations

import datetime as dt
import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from causeway.operators import forecast as T
from causeway.operators import media as X
from causeway.operators import survival as S


def weekly(spark, n=260, kink=None, sd=1.0):
    rng = np.random.default_rng(12)
    days = [dt.date(2015, 1, 5) + dt.timedelta(weeks=i) for i in range(n)]
    t = np.arange(n) / 52.18
    y = 100 + 10 * t + 8 * np.sin(2 * np.pi * t) + rng.normal(0, sd, n)
    if kink is not None:
        y = y + np.maximum(np.arange(n) - kink, 0) * 1.5
    return spark.createDataFrame(pd.DataFrame({"time": days, "value": y}))


def test_regular_series_fills_gaps(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 1, 4), 2.0), ("b", dt.date(2024, 2, 1), 3.0)],
                               "g string, d date, v double")
    out = T.regular_series(df, "d", "v", "day", ["g"]).orderBy("g", "time").collect()
    assert [(r.g, r.time.day, r.value) for r in out] == [("a", 1, 1.0), ("a", 2, None), ("a", 3, None), ("a", 4, 2.0), ("b", 1, 3.0)]
    with pytest.raises(ValueError, match="freq"):
        T.regular_series(df, "d", "v", "hour")


def test_calendar_fit_equals_numpy_ridge(spark):
    series = weekly(spark)
    model = T.CalendarForecast(order=4, strength=0.5, knots=(16800.0, 17200.0))
    fit = model.fit(series.repartition(3))
    pdf = series.toPandas()
    days = (pd.to_datetime(pdf.time) - pd.Timestamp("1970-01-01")).dt.days.to_numpy(float)
    z = np.column_stack([np.ones(len(days)), fit.design.expand(days[:, None])])
    p = np.diag(np.concatenate([[0.0], model.penalty(fit.design)]))
    y = (pdf.value - pdf.value.mean()) / pdf.value.std(ddof=0)
    b = np.linalg.solve(z.T @ z + p, z.T @ y)
    want = z @ b * pdf.value.std(ddof=0) + pdf.value.mean()
    got = T.fitted_rows(fit, series, components=True).orderBy("time").toPandas()
    assert np.allclose(got["mean"], want, atol=1e-6)
    assert np.abs(got.value - got["mean"]).mean() < 1.5
    parts = got[["trend", "month_trend", "seasonality", "changepoints"]].sum(axis=1)
    assert np.allclose((got["mean"] - parts).std(), 0.0, atol=1e-6)


def test_forecast_covers_the_truth(spark):
    series = weekly(spark, 260)
    train = series.filter(F.col("time") < F.lit(dt.date(2019, 11, 1)))
    fit = T.CalendarForecast(order=3, knots=()).fit(train)
    ahead = T.forecast(fit, train, 4)
    assert ahead.count() == 4
    rows = ahead.orderBy("time").toPandas()
    t = (pd.to_datetime(rows.time) - pd.Timestamp("2015-01-05")).dt.days.to_numpy() / 7 / 52.18
    truth = 100 + 10 * t + 8 * np.sin(2 * np.pi * t)  # the signal without noise
    assert ((truth > rows.lower) & (truth < rows.upper)).all()
    assert (rows.upper - rows.lower).between(2 * 1.96 * 0.8, 2 * 1.96 * 1.3).all()


def test_changepoint_is_found(spark):
    days = T.select_changepoints(weekly(spark, 260, kink=130, sd=0.3), order=3)
    start = (dt.date(2015, 1, 5) - dt.date(1970, 1, 1)).days
    assert any(abs((d - start) / 7 - 130) < 12 for d in days)
    facts = T.series_facts(weekly(spark, 260))
    knots = T.candidate_knots(facts)
    assert max(knots) <= facts.last - 60 and np.allclose(np.diff(knots), 14)


def test_cv_splits_and_block_training_sets(spark):
    series = weekly(spark, 130)
    splits = T.cv_splits(series, 4, 104, 6).orderBy("split").collect()
    assert [r.n_train for r in splits] == [126, 122, 118, 114, 110, 106]
    model = T.CalendarForecast(order=3, strength=1.0, knots=())
    scores = T.cross_validate(model, series, 4, 104, 6)
    pdf = series.toPandas().sort_values("time").reset_index(drop=True)
    facts = T.series_facts(series)
    days = (pd.to_datetime(pdf.time) - pd.Timestamp("1970-01-01")).dt.days.to_numpy(float)
    d = model.design(facts, ())
    z = np.column_stack([np.ones(len(days)), d.expand(days[:, None])])
    y = (pdf.value.to_numpy() - facts.mean) / facts.std
    p = np.diag(np.concatenate([[0.0], model.penalty(d)]))
    got = {(r.split, r.part): r.mape for r in scores.collect()}
    for r in splits:
        n = r.n_train
        b = np.linalg.solve(z[:n].T @ z[:n] + p, z[:n].T @ y[:n])
        f = z[n:n + 4] @ b * facts.std + facts.mean
        want = np.mean(np.abs((pdf.value[n:n + 4] - f) / pdf.value[n:n + 4])) * 100
        assert got[(r.split, "test")] == pytest.approx(want, rel=1e-6)
    ranks = T.rank_candidates(T.cross_validate(model, series, strengths=(0.1, 100.0))).orderBy("rank").collect()
    assert ranks[0].mean_test_mape <= ranks[1].mean_test_mape
    with pytest.raises(ValueError, match="too short"):
        T.cross_validate(model, weekly(spark, 60))


# ---------------------------------------------------------------- media


@pytest.fixture(scope="module")
def ads(spark):
    rng = np.random.default_rng(13)
    n = 300
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    x = {c: rng.gamma(2.0, 50.0, n) for c in ("tv", "web")}
    sales = np.full(n, 200.0)
    for c, beta in (("tv", 400.0), ("web", 150.0)):
        stock = np.zeros(n)
        for j in range(9):
            stock[j:] += 0.3**j * x[c][: n - j]
        k = x[c].mean()
        sales += beta * stock / (stock + k)
    sales += rng.normal(0, 3, n)
    media = spark.createDataFrame([(d, c, float(x[c][i]), float(x[c][i]) * 2) for c in x for i, d in enumerate(days)],
                                  "date date, channel string, x double, spend double")
    return media, spark.createDataFrame([(d, float(s)) for d, s in zip(days, sales)], "date date, sales double")


def test_media_fit_recovers_shape_and_effects(spark, ads):
    media, target = ads
    fit, scores = X.fit_media(media.repartition(5), target, ["tv", "web"], strength=1e-4)
    assert scores.count() == 18
    assert (fit.decay, fit.half, fit.slope) == (0.3, 1.0, 1.0)
    betas = {r.channel: r.beta for r in fit.params(spark).collect()}
    assert betas["tv"] == pytest.approx(400.0, rel=0.1)
    assert betas["web"] == pytest.approx(150.0, rel=0.1)
    boot = {r.channel: r for r in X.bootstrap_effects(media, target, fit, replicates=60, strength=1e-4).collect()}
    assert boot["tv"].lower < 400 < boot["tv"].upper
    assert boot["tv"].upper - boot["tv"].lower < 200
    with pytest.raises(ValueError, match="radio"):
        X.fit_media(media, target, ["radio"])


def test_contribution_and_baseline_add_up(spark, ads):
    media, target = ads
    params = spark.createDataFrame([("tv", 0.3, 100.0, 1.0, 400.0), ("web", 0.3, 100.0, 1.0, 150.0)],
                                   "channel string, decay double, half double, slope double, beta double")
    effects = X.channel_effects(media, params)
    split = X.baseline_split(effects, target).toPandas()
    assert np.allclose(split.media + split.baseline, split.sales)
    c = X.contribution(effects, target).toPandas()
    assert c.contribution.sum() == pytest.approx(split.media.sum())


@pytest.mark.parametrize("slopes", [(1.0, 0.7), (1.0, 2.0)])
def test_budget_split_against_enumeration(spark, slopes):
    rows = [("a", 30.0, slopes[0], 100.0, 1.0), ("b", 20.0, slopes[1], 80.0, 2.0)]
    params = spark.createDataFrame(rows, "channel string, half double, slope double, beta double, price double")
    got = {r.channel: r for r in X.budget_split(params, 200.0, 50).collect()}

    def response(r, spend):
        x = spend / r[4]
        return r[3] * x ** r[2] / (x ** r[2] + r[1] ** r[2]) if x else 0.0

    best = max(response(rows[0], 4.0 * i) + response(rows[1], 4.0 * (50 - i)) for i in range(51))
    total = got["a"].response + got["b"].response
    assert got["a"].spend + got["b"].spend <= 200.0 + 1e-9
    assert total == pytest.approx(best, rel=1e-9)


# ---------------------------------------------------------------- survival


@pytest.fixture(scope="module")
def patients(spark):
    rng = np.random.default_rng(14)
    n = 300
    pdf = pd.DataFrame({
        "id": np.arange(n), "g": rng.choice(["x", "y"], n, p=[0.7, 0.3]), "time": rng.integers(1, 40, n).astype(float),
        "event": rng.random(n) < 0.6, "risk": np.round(rng.normal(size=n), 1), "age": rng.normal(50, 10, n)})
    return spark.createDataFrame(pdf).repartition(4), pdf


def test_survival_curve(patients):
    df, pdf = patients
    got = {(r.g, r.time): r for r in S.survival_curve(df, "time", "event", ["g"]).collect()}
    count = 0
    for g, part in pdf.groupby("g"):
        s = 1.0
        for t in sorted(part.time[part.event].unique()):
            n, d = (part.time >= t).sum(), ((part.time == t) & part.event).sum()
            s *= 1 - d / n
            assert got[(g, t)].survival == pytest.approx(s, abs=1e-12)
            assert (got[(g, t)].at_risk, got[(g, t)].events) == (n, d)
            count += 1
    assert len(got) == count


def test_survival_reaches_zero_when_all_die(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True)], "time double, event boolean")
    out = S.survival_curve(df, "time", "event").orderBy("time").collect()
    assert [r.survival for r in out] == [0.5, 0.0]


def test_log_rank(patients):
    df, pdf = patients
    o = e = v = 0.0
    for t in sorted(pdf.time[pdf.event].unique()):
        at = pdf[pdf.time >= t]
        n, n1 = len(at), (at.g == "x").sum()
        hit = at[(at.time == t) & at.event]
        d, d1 = len(hit), (hit.g == "x").sum()
        o, e = o + d1, e + d * n1 / n
        v += d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) if n > 1 else 0
    r = S.log_rank(df, "time", "event", "g", "x", "y").first()
    assert (r.observed, r.expected, r.variance) == (o, pytest.approx(e), pytest.approx(v))
    assert r.chi_square == pytest.approx((o - e) ** 2 / v)


def brute(pdf):
    comparable = concordant = tied = 0
    for i, j in itertools.product(pdf.itertuples(), pdf.itertuples()):
        if i.event and (j.time > i.time or (j.time == i.time and not j.event)):
            comparable += 1
            concordant += i.risk > j.risk
            tied += i.risk == j.risk
    return comparable, concordant, tied


def test_concordance_equals_pair_count(spark, patients):
    df, pdf = patients
    r = S.concordance(df, "time", "event", "risk").first()
    want = brute(pdf)
    assert (r.comparable, r.concordant, r.tied) == want
    assert r.concordance == pytest.approx((want[1] + want[2] / 2) / want[0])
    hot = pdf.assign(risk=np.where(pdf.index % 3 == 0, 0.5, pdf.risk))
    r = S.concordance(spark.createDataFrame(hot), "time", "event", "risk").first()
    assert (r.comparable, r.concordant, r.tied) == brute(hot)
    flat = S.concordance(spark.createDataFrame(pdf.assign(risk=1.0)), "time", "event", "risk").first()
    assert flat.concordance == 0.5


def test_hazard_forest_orders_risk(spark):
    rng = np.random.default_rng(15)
    n = 600
    x = rng.random(n)
    life = rng.exponential(1 / (0.02 + 0.2 * x))
    stop = rng.uniform(5, 60, n)
    pdf = pd.DataFrame({"id": np.arange(n), "x": x, "z": rng.random(n), "time": np.minimum(life, stop), "event": life <= stop})
    df = spark.createDataFrame(pdf)
    model = S.HazardForest.fit(df, ["x", "z"], "time", "event", trees=30, depth=5)
    curves = model.curves(df.filter("id < 5"), "id").toPandas().sort_values(["id", "period"])
    for _, c in curves.groupby("id"):
        assert (np.diff(c.survival) <= 0).all() and c.survival.between(0, 1).all()
    scored = df.join(model.risk(df, "id"), "id")
    got = S.concordance(scored, "time", "event", "risk").first().concordance
    best = S.concordance(df, "time", "event", "x").first().concordance  # the true ordering of hazards
    assert best > 0.6 and got > best - 0.03


def test_survival_edges(spark):
    empty = spark.createDataFrame([], "time double, event boolean, g string, risk double")
    assert S.survival_curve(empty, "time", "event", ["g"]).count() == 0
    assert S.concordance(empty, "time", "event", "risk").first().concordance is None
    one = spark.createDataFrame([(3.0, True, "x", 1.0), (None, True, "x", 2.0)], "time double, event boolean, g string, risk double")
    assert [(r.time, r.survival) for r in S.survival_curve(one, "time", "event").collect()] == [(3.0, 0.0)]
    with pytest.raises(ValueError, match="at risk"):
        S.log_rank(one, "time", "event", "g", "x", "y")
    with pytest.raises(ValueError, match="not found"):
        S.survival_curve(one, "when", "event")
