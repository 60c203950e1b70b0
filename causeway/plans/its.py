"""Interrupted-time-series queries on monthly order value per priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from causeway.operators import its
from causeway.operators.its import SegmentedOls, effects_per_group
from causeway.plans.common import PANEL_SQL, POINTS, POOLED_SQL, SEGMENT_SQL, orders_panel
from causeway.plans.registry import query

_NAME = "CASE WHEN p = 0 THEN 'Pre-intervention' ELSE 'Intervention_D_' || p END"


def pooled(spark, sf, cov_type="nonrobust"):
    return SegmentedOls("time", POINTS, "group", bucketed=True).fit(orders_panel(spark, sf), "value", cov_type=cov_type)


def rounded(df, digits: int, *columns: str):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("i1_validate", f"WITH {PANEL_SQL} SELECT min(time) AS lo, max(time) AS hi, 2 AS n_points FROM panel")
def i1_validate(spark, sf):
    rows = orders_panel(spark, sf)
    its.validate(rows, "time", POINTS, "group")
    return rows.agg(F.min("time").alias("lo"), F.max("time").alias("hi"), F.lit(len(POINTS)).alias("n_points"))


@query("i2_design", f"""WITH {SEGMENT_SQL} SELECT grp AS "group", time, time - min(time) OVER (PARTITION BY grp) + 1 AS t,
 CAST(p = 1 AS INTEGER) AS "D_1", CASE WHEN p = 1 THEN row_number() OVER w ELSE 0 END AS timedelta_1,
 CAST(p = 2 AS INTEGER) AS "D_2", CASE WHEN p = 2 THEN row_number() OVER w ELSE 0 END AS timedelta_2, 1 AS const
FROM seg WINDOW w AS (PARTITION BY grp, p ORDER BY time)""")
def i2_design(spark, sf):
    return its.design(orders_panel(spark, sf), "time", POINTS, "group", bucketed=True).drop("value", "n_orders")


_COEF_SQL = f"""WITH {POOLED_SQL}, f1 AS (SELECT a, b FROM fit WHERE p = 1), f2 AS (SELECT a, b FROM fit WHERE p = 2),
 terms AS (SELECT 'const' AS term, a0 - b0 AS coef FROM pre UNION ALL SELECT 't', b0 FROM pre
  UNION ALL SELECT 'D_1', f1.a - a0 + (f1.b - b0) * 26 FROM pre, f1 UNION ALL SELECT 'timedelta_1', f1.b - b0 FROM pre, f1
  UNION ALL SELECT 'D_2', f2.a - a0 + (f2.b - b0) * 53 FROM pre, f2 UNION ALL SELECT 'timedelta_2', f2.b - b0 FROM pre, f2)"""


@query("i3_segmented_ols", _COEF_SQL + " SELECT term, round(coef, 4) AS coef FROM terms")
def i3_segmented_ols(spark, sf):
    return rounded(pooled(spark, sf, "HAC").coefficient_table(spark).select("term", "coef"), 4, "coef")


@query("i3_numeric_covariate", f"""WITH {SEGMENT_SQL}, f AS (SELECT p, regr_slope(value, time) AS by_, regr_intercept(value, time) AS ay,
  regr_slope(n_orders, time) AS bx, regr_intercept(n_orders, time) AS ax FROM seg GROUP BY 1),
 r AS (SELECT value - ay - by_*time AS ry, n_orders - ax - bx*time AS rx FROM seg JOIN f USING (p)),
 c AS (SELECT sum(ry*rx)/sum(rx*rx) AS c FROM r),
 g AS (SELECT max(CASE WHEN p = 0 THEN ay - c*ax END) AS a0, max(CASE WHEN p = 0 THEN by_ - c*bx END) AS b0,
  max(CASE WHEN p = 1 THEN ay - c*ax END) AS a1, max(CASE WHEN p = 1 THEN by_ - c*bx END) AS b1,
  max(CASE WHEN p = 2 THEN ay - c*ax END) AS a2, max(CASE WHEN p = 2 THEN by_ - c*bx END) AS b2, max(c) AS c FROM f CROSS JOIN c)
SELECT 'const' AS term, round(a0 - b0, 3) AS coef FROM g UNION ALL SELECT 't', round(b0, 3) FROM g
UNION ALL SELECT 'D_1', round(a1 - a0 + (b1 - b0)*26, 3) FROM g UNION ALL SELECT 'timedelta_1', round(b1 - b0, 3) FROM g
UNION ALL SELECT 'D_2', round(a2 - a0 + (b2 - b0)*53, 3) FROM g UNION ALL SELECT 'timedelta_2', round(b2 - b0, 3) FROM g
UNION ALL SELECT 'n_orders', round(c, 3) FROM g""")
def i3_numeric_covariate(spark, sf):
    model = SegmentedOls("time", POINTS, "group", bucketed=True).fit(orders_panel(spark, sf), "value", ["n_orders"])
    return rounded(model.coefficient_table(spark).select("term", "coef"), 3, "coef")


@query("i3_with_covariates")
def i3_with_covariates(spark, sf):
    model = SegmentedOls("time", POINTS, "group", bucketed=True).fit(orders_panel(spark, sf), "value", ["n_orders", "group"])
    return model.coefficient_table(spark)


@query("i4_fitted_values", f"""WITH {POOLED_SQL} SELECT grp AS "group", time, round(a + b*time, 3) AS mean,
 round(a + b*time - 1.959963984540054::DOUBLE*sqrt(s2*(1.0/n + (time-mt)*(time-mt)/sxx)), 3) AS mean_ci_lower,
 round(a + b*time + 1.959963984540054::DOUBLE*sqrt(s2*(1.0/n + (time-mt)*(time-mt)/sxx)), 3) AS mean_ci_upper
FROM seg JOIN fit USING (p) CROSS JOIN sig""")
def i4_fitted_values(spark, sf):
    out = pooled(spark, sf).predict(interval=True)
    return rounded(out.select("group", "time", "mean", "mean_ci_lower", "mean_ci_upper"), 3,
                   "mean", "mean_ci_lower", "mean_ci_upper")


@query("i4_new_rows", f"""WITH {POOLED_SQL} SELECT grp AS "group", time, round(a + b*time, 3) AS mean
FROM seg JOIN fit USING (p) WHERE time >= 60""")
def i4_new_rows(spark, sf):
    """Rows that begin inside the last period get the values they have in the whole panel."""
    late = orders_panel(spark, sf).filter("time >= 60")
    return rounded(pooled(spark, sf).predict(late).select("group", "time", "mean"), 3, "mean")


@query("i5_counterfactual", f"""WITH {POOLED_SQL} SELECT grp AS "group", time, round(a0 + b0*time, 3) AS mean
FROM seg CROSS JOIN pre""")
def i5_counterfactual(spark, sf):
    return rounded(pooled(spark, sf).counterfactual(interval=False).select("group", "time", "mean"), 3, "mean")


@query("i6_effect_table", f"""WITH {SEGMENT_SQL},
 g AS (SELECT grp, p, regr_slope(value, time) AS b, regr_intercept(value, time) AS a FROM seg GROUP BY 1, 2)
SELECT seg.grp AS "group", {_NAME.replace('p =', 'seg.p =').replace('|| p', '|| seg.p')} AS "Period", count(*) AS n_obs,
 round(avg(value), 3) AS "Actual_mean", round(avg(own.a + own.b*time), 3) AS "Predicted_mean",
 round(avg(pre.a + pre.b*time), 3) AS "Counterfactual_mean", round(avg(value - pre.a - pre.b*time), 3) AS "Effect_mean"
FROM seg JOIN g own ON own.grp = seg.grp AND own.p = seg.p JOIN g pre ON pre.grp = seg.grp AND pre.p = 0 GROUP BY 1, 2""")
def i6_effect_table(spark, sf):
    out = effects_per_group(orders_panel(spark, sf), "time", POINTS, "value", "group", bucketed=True)
    return rounded(out, 3, *its.EFFECT_COLUMNS)


@query("i6_effect_table_pooled", f"""WITH {POOLED_SQL} SELECT grp AS "group", {_NAME} AS "Period",
 round(avg(value), 3) AS "Actual_mean", round(avg(a + b*time), 3) AS "Predicted_mean",
 round(avg(a0 + b0*time), 3) AS "Counterfactual_mean", round(avg(value - a0 - b0*time), 3) AS "Effect_mean"
FROM seg JOIN fit USING (p) CROSS JOIN pre GROUP BY 1, 2""")
def i6_effect_table_pooled(spark, sf):
    return rounded(pooled(spark, sf).effects(), 3, *its.EFFECT_COLUMNS)


@query("i7_level_and_trend", _COEF_SQL + """ SELECT CAST(right(term, 1) AS INTEGER) AS intervention,
 CASE WHEN term LIKE 'D_%' THEN 'level' ELSE 'trend' END AS effect, term, round(coef, 4) AS coef
FROM terms WHERE term LIKE '%\\_1' ESCAPE '\\' OR term LIKE '%\\_2' ESCAPE '\\'""")
def i7_level_and_trend(spark, sf):
    out = pooled(spark, sf).intervention_effects(spark)
    return rounded(out.select("intervention", "effect", "term", "coef"), 4, "coef")


@query("m6_prediction_intervals", f"""WITH {POOLED_SQL}, v AS (SELECT grp, time, a + b*time AS m,
 s2*(1.0/n + (time-mt)*(time-mt)/sxx) AS q, s2 FROM seg JOIN fit USING (p) CROSS JOIN sig)
SELECT grp AS "group", time, round(m, 3) AS mean, round(sqrt(q), 4) AS mean_se,
 round(m - 1.959963984540054::DOUBLE*sqrt(q + s2), 3) AS obs_ci_lower,
 round(m + 1.959963984540054::DOUBLE*sqrt(q + s2), 3) AS obs_ci_upper FROM v""")
def m6_prediction_intervals(spark, sf):
    out = pooled(spark, sf).predict(interval=True).select("group", "time", "mean", "mean_se", "obs_ci_lower", "obs_ci_upper")
    return rounded(rounded(out, 3, "mean", "obs_ci_lower", "obs_ci_upper"), 4, "mean_se")


@query("s7_plot_frame", f"""WITH {POOLED_SQL} SELECT grp AS "group", time, {_NAME} AS phase, round(value, 2) AS actual,
 round(a + b*time, 3) AS fitted, round(a0 + b0*time, 3) AS counterfactual,
 round(a0 + b0*time - 1.959963984540054::DOUBLE*sqrt(s2*(1.0/n0 + (time-mt0)*(time-mt0)/sxx0)), 3) AS counterfactual_lower,
 round(a0 + b0*time + 1.959963984540054::DOUBLE*sqrt(s2*(1.0/n0 + (time-mt0)*(time-mt0)/sxx0)), 3) AS counterfactual_upper
FROM seg JOIN fit USING (p) CROSS JOIN pre CROSS JOIN sig""")
def s7_plot_frame(spark, sf):
    out = rounded(pooled(spark, sf).plot_frame(), 2, "actual")
    return rounded(out, 3, "fitted", "counterfactual", "counterfactual_lower", "counterfactual_upper")


_PLACEBO_SQL = f"""WITH {PANEL_SQL}, c AS (SELECT * FROM (VALUES (6.5), (13.0), (19.5)) v(point)),
 x AS (SELECT *, time >= point AS post FROM panel CROSS JOIN c WHERE time < 27),
 f AS (SELECT point, regr_slope(value, time) AS b, regr_intercept(value, time) AS a FROM x WHERE NOT post GROUP BY 1),
 g AS (SELECT point, grp, avg(value - a - b*time) AS e FROM x JOIN f USING (point) WHERE post GROUP BY 1, 2),
 e AS (SELECT CAST(point AS DOUBLE) AS placebo_point, avg(e) AS effect FROM g GROUP BY 1)"""


@query("i12_placebo_effects", _PLACEBO_SQL + " SELECT placebo_point, round(effect, 3) AS placebo_effect FROM e")
def i12_placebo_effects(spark, sf):
    out = SegmentedOls("time", POINTS, "group", bucketed=True).placebo_effects(orders_panel(spark, sf), "value")
    return rounded(out, 3, "placebo_effect")


@query("i12_placebo_test", _PLACEBO_SQL + """, s AS (SELECT avg(effect) AS m, stddev_pop(effect) AS sp,
 avg(effect) / (stddev_samp(effect) / sqrt(3.0::DOUBLE)) AS t FROM e)
SELECT round(m, 3) AS mean_placebo_effect, round(sp, 3) AS std_placebo_effect, round(t, 7) AS t_statistic,
 round(1 - abs(t) / sqrt(2 + t*t), 8) AS p_value, 1 - abs(t) / sqrt(2 + t*t) > 0.05 AS is_valid,
 3::BIGINT AS n_placebo_tests FROM s""")
def i12_placebo_test(spark, sf):
    out = SegmentedOls("time", POINTS, "group", bucketed=True).placebo_test(orders_panel(spark, sf), "value")
    out = rounded(out.drop("placebo_points", "placebo_effects"), 3, "mean_placebo_effect", "std_placebo_effect")
    return out.withColumns({"t_statistic": F.round("t_statistic", 7), "p_value": F.round("p_value", 8)})


@query("i13_placebo_per_intervention", f"""WITH {PANEL_SQL}, c AS (SELECT i, lo, hi, CAST(lo + (j + 1) * (hi - 1 - lo) / 4.0 AS DOUBLE) AS point
  FROM (VALUES (0, 0, 27), (1, 27, 54)) v(i, lo, hi) CROSS JOIN range(3) r(j)),
 x AS (SELECT *, time >= point AS post FROM panel JOIN c ON time >= lo AND time < hi),
 f AS (SELECT i, point, regr_slope(value, time) AS b, regr_intercept(value, time) AS a FROM x WHERE NOT post GROUP BY 1, 2),
 g AS (SELECT i, hi, point, grp, avg(value - a - b*time) AS e FROM x JOIN f USING (i, point) WHERE post GROUP BY 1, 2, 3, 4)
SELECT i AS real_intervention_index, CAST(hi AS DOUBLE) AS real_intervention_point, point AS placebo_point,
 round(avg(e), 3) AS placebo_effect, round(stddev_samp(e), 3) AS placebo_effect_std FROM g GROUP BY 1, 2, 3""")
def i13_placebo_per_intervention(spark, sf):
    out = SegmentedOls("time", POINTS, "group", bucketed=True).placebo_per_intervention(orders_panel(spark, sf), "value")
    return rounded(out, 3, "placebo_effect", "placebo_effect_std")


@query("i14_window_sensitivity", f"""WITH {PANEL_SQL},
 c AS (SELECT point, a, b FROM (VALUES (27), (54)) p(point) CROSS JOIN (VALUES (12,12), (18,12), (12,18), (24,12), (12,24)) w(a, b)),
 x AS (SELECT *, time >= point AS post FROM panel JOIN c ON time BETWEEN point - a AND point + b),
 f AS (SELECT point, a, b, regr_slope(value, time) AS k, regr_intercept(value, time) AS h FROM x WHERE NOT post GROUP BY 1, 2, 3),
 g AS (SELECT point, a, b, grp, avg(value - h - k*time) AS e FROM x JOIN f USING (point, a, b) WHERE post GROUP BY 1, 2, 3, 4)
SELECT CAST(point AS DOUBLE) AS intervention_point, a AS pre_window, b AS post_window, round(avg(e), 3) AS effect_mean,
 round(stddev_samp(e), 3) AS effect_std FROM g GROUP BY 1, 2, 3""")
def i14_window_sensitivity(spark, sf):
    out = SegmentedOls("time", POINTS, "group", bucketed=True).window_sensitivity(orders_panel(spark, sf), "value")
    return rounded(out, 3, "effect_mean", "effect_std")
