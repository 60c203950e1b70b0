"""Scans that carry a state over blocks, against plain loops."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from causeway.operators import media as X
from causeway.operators.ordered import _compose, _entering, Edge, affine_scan
from causeway.operators.windows import adstock


def recursion(pdf, by, decay):
    out = {}
    for key, part in pdf.sort_values("t").groupby(by, dropna=False) if by else [((), pdf.sort_values("t"))]:
        state = 0.0
        for r in part.itertuples():
            state = (r.d if decay == "d" else decay) * state + (0.0 if pd.isna(r.x) else r.x)
            out[r.i] = state
    return out


def test_compose_equals_the_loop():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 200):
        a, b, starts = rng.random((n, 2)), rng.normal(size=(n, 2)), rng.random(n) < 0.2
        starts[0] = True
        pa, pb = _compose(a, b, starts)
        for j in range(2):
            x = y = 0.0
            for i in range(n):
                x, y = (a[i, j], b[i, j]) if starts[i] else (a[i, j] * x, b[i, j] + a[i, j] * y)
                assert (pa[i, j], pb[i, j]) == pytest.approx((x, y), rel=1e-12, abs=1e-12)


def test_states_pass_over_blocks():
    edges = [Edge(0, ("a",), ("b",), False, [0.5], [1.0]), Edge(2, ("b",), ("b",), True, [0.25], [3.0]), Edge(5, ("b",), ("c",), False, [0.1], [9.0]),
             Edge(6, ("d",), ("d",), True, [0.1], [2.0])]
    assert _entering(edges, 1) == {0: [0.0], 2: [1.0], 5: [3.25], 6: [0.0]}


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_hot_series_over_many_tasks(spark, partitions):
    """One series holds most rows, decay 0.99: every earlier row counts, and the series spans tasks."""
    rng = np.random.default_rng(2)
    n = 6000
    pdf = pd.DataFrame({"i": np.arange(n), "g": rng.choice(["hot", "b", None, "z"], n, p=[0.9, 0.04, 0.03, 0.03]), "t": rng.permutation(n), "x": rng.gamma(2.0, 10.0, n)})
    pdf.loc[::50, "x"] = np.nan
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.createDataFrame(pdf.to_dict("records"), "i bigint, g string, t bigint, x double")
        df = df.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
        got = {r.i: r.s for r in adstock(df, ["g"], "t", "x", 0.99, "s").collect()}
        if partitions > 1:
            from causeway.operators.ordered import place

            assert place(df, ["g"], [F.col("t")]).filter("g = 'hot'").select("_block").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = recursion(pdf, "g", 0.99)
    assert len(got) == n and all(got[i] == pytest.approx(want[i], rel=1e-9) for i in want)


def test_decays_by_row_several_states_and_keys(spark):
    rng = np.random.default_rng(3)
    n = 500
    pdf = pd.DataFrame({"i": np.arange(n), "g": rng.integers(0, 5, n), "h": rng.choice(list("ab"), n), "t": rng.permutation(n),
                        "x": rng.normal(size=n), "d": rng.random(n)})
    out = affine_scan(spark.createDataFrame(pdf).repartition(7), ["g", "h"], [F.col("t")],
                      {"varying": (F.col("d"), F.col("x")), "sum": (F.lit(1.0), F.col("x"))}).collect()
    pdf["x0"] = pdf.x
    varying, total = recursion(pdf, ["g", "h"], "d"), recursion(pdf, ["g", "h"], 1.0)
    assert all(r.varying == pytest.approx(varying[r.i], rel=1e-9, abs=1e-12) and r["sum"] == pytest.approx(total[r.i], rel=1e-9, abs=1e-9) for r in out)
    whole = affine_scan(spark.createDataFrame(pdf), [], [F.col("t")], {"s": (F.lit(0.5), F.col("x"))}).collect()
    want = recursion(pdf, [], 0.5)
    assert all(r.s == pytest.approx(want[r.i], rel=1e-9, abs=1e-12) for r in whole)


def test_scan_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, t int, x double")
    assert adstock(empty, ["g"], "t", "x", 0.5, "s").collect() == []


# ---------------------------------------------------------------- media


PLANTED = {"tv": (0.6, 1.0, 1.0, 300.0), "web": (0.0, 2.0, 0.7, 200.0), "radio": (0.3, 0.5, 1.0, 120.0)}


@pytest.fixture(scope="module")
def mix(spark):
    rng = np.random.default_rng(21)
    n = 500
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    x = {c: rng.gamma(0.7, 80.0, n) for c in PLANTED}
    sales = np.full(n, 300.0)
    for c, (decay, half, slope, beta) in PLANTED.items():
        state, mean = 0.0, x[c].mean()
        for i in range(n):
            state = decay * state + x[c][i] / mean
            sales[i] += beta * state**slope / (state**slope + half**slope) if state else 0.0
    sales += rng.normal(0, 2, n)
    media = spark.createDataFrame([(d, c, float(x[c][i]), 1.0) for c in x for i, d in enumerate(days)],
                                  "date date, channel string, x double, spend double")
    return media, spark.createDataFrame([(d, float(s)) for d, s in zip(days, sales)], "date date, sales double"), days


def test_channels_get_their_own_shapes(spark, mix):
    media, sales, _ = mix
    fit, scores = X.fit_media(media, sales, strength=1e-6, own_shapes=True)
    assert fit.channels == ("radio", "tv", "web") and scores.count() == 18
    assert dict(zip(fit.channels, fit.shapes, strict=True)) == {c: PLANTED[c][:3] for c in PLANTED}
    betas = {r.channel: r.beta for r in fit.params(spark).collect()}
    assert all(betas[c] == pytest.approx(PLANTED[c][3], rel=0.05) for c in PLANTED)
    assert fit.rss < scores.agg(F.min("rss")).first()[0]
    with pytest.raises(ValueError, match="their own"):
        fit.decay


def test_prediction_of_held_out_dates(spark, mix):
    media, sales, days = mix
    cut = F.col("date") < F.lit(days[450])
    fit, _ = X.fit_media(media.filter(cut), sales.filter(cut), strength=1e-6, own_shapes=True)
    rows = fit.predict(media).join(sales, "date").filter(~cut).toPandas()
    assert len(rows) == 50
    assert np.abs(rows.predicted - rows.sales).mean() < 3.0
    inside = fit.predict(media.filter(cut)).join(sales, "date").toPandas()
    err = (inside.predicted - inside.sales) / fit.sales_scale
    assert float((err**2).sum()) == pytest.approx(fit.rss, rel=1e-6)


def test_posterior_covers_the_planted_effects(spark, mix):
    media, sales, _ = mix
    fit, _ = X.fit_media(media, sales, strength=1e-6, own_shapes=True)
    draws = X.posterior_draws(spark, fit, chains=4, draws=400, warmup=200, seed=5)
    rows = {r.channel: r for r in X.posterior_effects(draws).collect()}
    for c, (_, _, _, beta) in PLANTED.items():
        assert rows[c].lower < beta < rows[c].upper and rows[c].mean == pytest.approx(beta, rel=0.05)
        assert rows[c].n_replicates == 1600 and rows[c].split_rhat < 1.05 and rows[c].upper - rows[c].lower < 0.2 * beta
    again = X.posterior_draws(spark, fit, chains=4, draws=400, warmup=200, seed=5)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, draws.collect()))
    other = X.posterior_draws(spark, fit, chains=1, draws=5, warmup=2, seed=6).collect()
    assert [r.beta for r in other] != [r.beta for r in draws.filter("chain = 0 AND draw < 5").collect()]


def test_posterior_without_an_effect_stays_at_zero(spark, mix):
    """A channel whose least-squares effect is negative: draws lie on the half line and near zero."""
    gram = np.array([[100.0, 0, 0, 0], [0, 50.0, 0, -20.0], [0, 0, 30.0, 30.0], [0, -20.0, 30.0, 200.0]])
    draws = X._gibbs(gram, 2, 3000, 300, np.random.default_rng(1))
    assert (draws[:, :2] >= 0).all()
    rss = 200.0 - 30.0**2 / 30.0
    assert draws[:, 0].mean() < 3 * np.sqrt(rss / 99 / 50)
    assert draws[:, 1].mean() == pytest.approx(1.0, abs=0.03) and draws[:, 1].std() == pytest.approx(np.sqrt(draws[:, 2].mean() ** 2 / 30), rel=0.1)


def test_poisson_weights_have_no_last_value(spark):
    u = [0.0, 0.3, float(np.exp(-1.0)) + 1e-9, 1 - 2.0**-29, 1 - 2.0**-30]
    got = [r.w for r in spark.createDataFrame([(v,) for v in u], "u double").select(X._poisson_weight(F.col("u")).alias("w")).collect()]
    assert got[:3] == [0.0, 0.0, 1.0] and got[3] > 8
    assert sorted(got) == got
