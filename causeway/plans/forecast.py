"""Forecasting queries on weekly order value, and the autoregressive and additive study models."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from causeway.operators import forecast as T
from causeway.operators import tables as R
from causeway.operators.additive import ItsAdditive
from causeway.operators.arima import ItsArima
from causeway.operators.its import SegmentedOls, compare_effects, effects_per_group
from causeway.plans.common import PANEL_SQL, POINTS, SEGMENT_SQL, orders_panel
from causeway.plans.registry import query
from causeway.sources.tables import load


def weekly(spark, sf):
    weeks = R.resample_weeks(load(spark, sf, "orders"), "o_orderdate", {"value": F.col("o_totalprice")})
    return weeks.select(F.col("week").alias("time"), "value")


@query("t1_regular_series", """WITH c AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2),
 r AS (SELECT o_orderpriority, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM c GROUP BY 1)
SELECT r.o_orderpriority, r.day AS time, round(coalesce(v, -1), 2) AS value FROM r LEFT JOIN c USING (o_orderpriority, day)""")
def t1_regular_series(spark, sf):
    out = T.regular_series(load(spark, sf, "orders"), "o_orderdate", "o_totalprice", "day", ["o_orderpriority"])
    return out.withColumn("value", F.round(F.coalesce("value", F.lit(-1.0)), 2))


@query("t2_ridge_forecast")
def t2_ridge_forecast(spark, sf):
    series = weekly(spark, sf)
    return T.fitted_rows(T.CalendarForecast().fit(series), series)


@query("t3_changepoint_selection")
def t3_changepoint_selection(spark, sf):
    series = weekly(spark, sf)
    days = T.select_changepoints(series)
    base = spark.createDataFrame([(i, float(d)) for i, d in enumerate(days)], "ord int, day double")
    return base.withColumn("date", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day").cast("int")))


@query("t4_cv_splits", """WITH w AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS time FROM orders GROUP BY 1),
 i AS (SELECT time FROM w WHERE time > (SELECT min(time) FROM w) AND time < (SELECT max(time) FROM w)),
 n AS (SELECT time, row_number() OVER (ORDER BY time) AS pos, count(*) OVER () AS n FROM i),
 s AS (SELECT CAST(ceil((n - pos + 1) / 4.0) AS INTEGER) AS split, min(time) AS test_start, max(time) AS test_end, min(pos) - 1 AS n_train
  FROM n GROUP BY 1, n HAVING ceil((n - min(pos) + 1) / 4.0) <= 6 AND min(pos) - 1 >= 104)
SELECT split, n.time AS train_end, test_start, test_end, n_train FROM s JOIN n ON n.pos = s.n_train""")
def t4_cv_splits(spark, sf):
    return T.cv_splits(weekly(spark, sf))


@query("t4_cross_validation")
def t4_cross_validation(spark, sf):
    return T.cross_validate(T.CalendarForecast(), weekly(spark, sf))


@query("t5_forecast_interval")
def t5_forecast_interval(spark, sf):
    series = weekly(spark, sf)
    return T.forecast(T.CalendarForecast().fit(series), series, 4)


@query("t5_trend_interval")
def t5_trend_interval(spark, sf):
    """Twelve weeks ahead with an interval that holds future changes of slope."""
    series = weekly(spark, sf)
    return T.forecast_with_trend(T.CalendarForecast().fit(series), series, 12)


@query("i10_additive_forecast")
def i10_additive_forecast(spark, sf):
    """A year ahead for every priority with the last intervention still on."""
    rows = orders_panel(spark, sf)
    fit = ItsAdditive("time", POINTS, "group").fit(rows, "value")
    ends = rows.groupBy("group").agg(F.max("time").alias("last"))
    ahead = ends.select("group", F.explode(F.sequence(F.col("last") + 1, F.col("last") + 12)).alias("time"))
    return fit.forecast(ahead).select("group", "time", "mean", "lower", "upper")


_T6_SQL = """WITH p AS (SELECT o_orderpriority AS grp, CAST((year(o_orderdate)-1995)*12+month(o_orderdate)-1 AS BIGINT) AS time,
  sum(o_totalprice) AS y FROM orders GROUP BY 1, 2),
 m AS (SELECT grp, regr_slope(y, time) AS b, regr_intercept(y, time) AS a FROM p WHERE time < 59 GROUP BY 1),
 e AS (SELECT grp, time >= 59 AS is_test, y, a + b*time AS f FROM p JOIN m USING (grp)),
 s AS (SELECT grp, is_test, count(*) AS n, avg(abs((y-f)/y))*100 AS mape, avg(abs(y-f)) AS mae, sqrt(avg((y-f)*(y-f))) AS rmse,
  1 - sum((y-f)*(y-f))/(var_pop(y)*count(*)) AS r2, corr(y, f) AS correlation FROM e GROUP BY 1, 2)"""


@query("t6_metrics", _T6_SQL + """ SELECT grp AS "group", is_test, n, round(mape, 6) AS mape, round(mae, 3) AS mae, round(rmse, 3) AS rmse,
 round(r2, 7) AS r2, round(correlation, 7) AS correlation,
 CAST(row_number() OVER (PARTITION BY is_test ORDER BY mape) AS INTEGER) AS rank FROM s""")
def t6_metrics(spark, sf):
    from causeway.operators.gram import apply_fit, fit_by
    from causeway.operators.ordered import row_number

    rows = orders_panel(spark, sf)
    fits = fit_by(rows.filter("time < 59"), ["time"], "value", ["group"])
    scored = apply_fit(rows, fits, ["time"], ["group"], "fitted").withColumn("is_test", F.col("time") >= 59)
    table = R.metric_table(scored, F.col("value"), F.col("fitted"), ["group", "is_test"])
    ranked = row_number(table, ["is_test"], [F.col("mape")], "rank").withColumn("rank", F.col("rank").cast("int"))
    digits = {"mape": 6, "mae": 3, "rmse": 3, "r2": 7, "correlation": 7}
    return ranked.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("t6_strength_ranking")
def t6_strength_ranking(spark, sf):
    scores = T.cross_validate(T.CalendarForecast(), weekly(spark, sf), strengths=(0.01, 0.1, 1.0, 10.0))
    return T.rank_candidates(scores)


@query("t7_components")
def t7_components(spark, sf):
    series = weekly(spark, sf)
    return T.fitted_rows(T.CalendarForecast().fit(series), series, components=True)


# ---------------------------------------------------------------- study models


@query("i8_arima_effects")
def i8_arima_effects(spark, sf):
    return ItsArima("time", POINTS, "group").fit(orders_panel(spark, sf), "value", (1, 0, 1)).effects()


@query("i8_arima_forecast")
def i8_arima_forecast(spark, sf):
    """Six months ahead for every priority with the last intervention still on."""
    rows = orders_panel(spark, sf)
    fit = ItsArima("time", POINTS, "group").fit(rows, "value", (1, 0, 1))
    ends = rows.groupBy("group").agg(F.max("time").alias("last"))
    ahead = ends.select("group", F.explode(F.sequence(F.col("last") + 1, F.col("last") + 6)).alias("time"))
    return fit.forecast(ahead)


@query("i8_exact_effects")
def i8_exact_effects(spark, sf):
    """The same study at the maximum of the exact likelihood."""
    return ItsArima("time", POINTS, "group").fit_exact(orders_panel(spark, sf), "value", (1, 0, 1)).effects()


_LEVEL_SQL = """SELECT seg.grp AS "group", CASE WHEN p = 0 THEN 'Pre-intervention' ELSE 'Intervention_D_' || p END AS "Period",
 avg(value) AS actual, max(m) AS without FROM seg JOIN (SELECT grp, avg(value) AS m FROM seg WHERE p = 0 GROUP BY 1) b USING (grp) GROUP BY 1, 2"""


@query("i8_exact_effects_white", f"""WITH {SEGMENT_SQL}, e AS ({_LEVEL_SQL})
SELECT "group", "Period", round(actual, 1) AS "Actual_mean", round(actual, 1) AS "Predicted_mean", round(without, 1) AS "Counterfactual_mean",
 round(actual - without, 1) + 0 AS "Effect_mean" FROM e""")
def i8_exact_effects_white(spark, sf):
    """With uncorrelated errors the exact likelihood is least squares on a constant and the intervention terms."""
    out = ItsArima("time", POINTS, "group").fit_exact(orders_panel(spark, sf), "value", (0, 0, 0)).effects()
    return out.withColumns({c: F.round(c, 1) + F.lit(0.0) for c in ("Actual_mean", "Predicted_mean", "Counterfactual_mean", "Effect_mean")})


@query("i9_order_search_white", f"""WITH {PANEL_SQL}, y AS (SELECT grp, value, value - lag(value) OVER (PARTITION BY grp ORDER BY time) AS step FROM panel WHERE time < 27),
 k AS (SELECT grp, 0 AS d, count(*) AS n, var_pop(value) AS v, 2 AS k FROM y GROUP BY 1
  UNION ALL SELECT grp, 1, count(step), sum(step * step) / count(step), 1 FROM y GROUP BY 1)
SELECT grp AS "group", 0 AS p, d, 0 AS q, 0 AS seasonal_p, 0 AS seasonal_d, 0 AS seasonal_q, 0 AS s, n AS n_obs,
 round(ln(2*pi()*v) + 1 + 2.0*k/n, 8) AS aic FROM k""")
def i9_order_search_white(spark, sf):
    """Scores of the orders without lags, where the likelihood has a closed form."""
    grid = {"p": (0,), "d": (0, 1), "q": (0,), "P": (0,), "D": (0,), "Q": (0,), "s": (0,)}
    return ItsArima("time", POINTS, "group").search(orders_panel(spark, sf), "value", grid).withColumn("aic", F.round("aic", 8))


@query("i15_model_comparison_white", f"""WITH {SEGMENT_SQL}, e AS ({_LEVEL_SQL}),
 g AS (SELECT grp, p, regr_slope(value, time) AS b, regr_intercept(value, time) AS a FROM seg WHERE p = 0 GROUP BY 1, 2),
 o AS (SELECT seg.grp AS "group", CASE WHEN seg.p = 0 THEN 'Pre-intervention' ELSE 'Intervention_D_' || seg.p END AS "Period", avg(value - a - b*time) AS effect
  FROM seg JOIN g USING (grp) GROUP BY 1, 2)
SELECT "group", "Period", round(effect, 1) + 0 AS effect_ols, round(actual - without, 1) + 0 AS effect_arima FROM o JOIN e USING ("group", "Period")""")
def i15_model_comparison_white(spark, sf):
    """Effects with a trend before the intervention next to those against a constant level."""
    rows = orders_panel(spark, sf)
    out = compare_effects({
        "ols": effects_per_group(rows, "time", POINTS, "value", "group", bucketed=True),
        "arima": ItsArima("time", POINTS, "group").fit_exact(rows, "value", (0, 0, 0)).effects()}, ["group", "Period"])
    return out.withColumns({c: F.round(c, 1) + F.lit(0.0) for c in ("effect_ols", "effect_arima")})


@query("i9_order_search")
def i9_order_search(spark, sf):
    return ItsArima("time", POINTS, "group").search(orders_panel(spark, sf), "value")


@query("i9_order_search_covariate")
def i9_order_search_covariate(spark, sf):
    return ItsArima("time", POINTS, "group").search(orders_panel(spark, sf), "value", {"d": (0, 1), "s": (0, 12)}, ["n_orders"])


@query("i10_additive_effects")
def i10_additive_effects(spark, sf):
    return ItsAdditive("time", POINTS, "group").fit(orders_panel(spark, sf), "value").effects()


@query("i11_changepoint_search")
def i11_changepoint_search(spark, sf):
    return ItsAdditive("time", (54,), "group").search(orders_panel(spark, sf), "value")


@query("i15_model_comparison")
def i15_model_comparison(spark, sf):
    rows = orders_panel(spark, sf)
    return compare_effects({
        "ols": SegmentedOls("time", POINTS, "group", bucketed=True).fit(rows, "value").effects(),
        "arima": ItsArima("time", POINTS, "group").fit(rows, "value").effects(),
        "additive": ItsAdditive("time", POINTS, "group").fit(rows, "value").effects(),
    }, ["group", "Period"])


@query("i15_placebo_summary")
def i15_placebo_summary(spark, sf):
    """Placebo tests of the three models under the same fake interventions."""
    rows = orders_panel(spark, sf)
    models = {"ols": partial(SegmentedOls, bucketed=True), "arima": ItsArima, "additive": ItsAdditive}
    out = None
    for name, kind in models.items():
        one = kind("time", POINTS, "group").placebo_test(rows, "value").drop("placebo_points", "placebo_effects")
        one = one.withColumn("model", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("i14_window_sensitivity_arima")
def i14_window_sensitivity_arima(spark, sf):
    return ItsArima("time", POINTS, "group").window_sensitivity(orders_panel(spark, sf), "value")


@query("i13_placebo_per_intervention_additive")
def i13_placebo_per_intervention_additive(spark, sf):
    return ItsAdditive("time", POINTS, "group").placebo_per_intervention(orders_panel(spark, sf), "value")
