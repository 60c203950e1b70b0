"""Regression, effect, saturation and curve queries on order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from causeway.operators import regress as M
from causeway.operators.regress import Regression
from causeway.plans.common import PANEL_SQL, month_index, orders_panel
from causeway.plans.registry import query
from causeway.sources.tables import load

_TWO_SQL = """s AS (SELECT count(*) AS n, avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_discount) AS m2,
  var_pop(l_extendedprice) AS syy, var_pop(l_quantity) AS s11, var_pop(l_discount) AS s22, covar_pop(l_quantity, l_discount) AS s12,
  covar_pop(l_extendedprice, l_quantity) AS s1y, covar_pop(l_extendedprice, l_discount) AS s2y FROM lineitem),
 c AS (SELECT *, (s1y*s22 - s2y*s12) / (s11*s22 - s12*s12) AS b1, (s2y*s11 - s1y*s12) / (s11*s22 - s12*s12) AS b2 FROM s),
 k AS (SELECT *, my - b1*m1 - b2*m2 AS b0, (b1*s1y + b2*s2y) / syy AS r2,
  n * (syy - b1*s1y - b2*s2y) / (n - 3) AS sig, s11*s22 - s12*s12 AS det FROM c)"""


def two_feature(spark, sf):
    return Regression.fit(load(spark, sf, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice")


@query("m1_ols", f"""WITH {_TWO_SQL} SELECT 'const' AS term, round(b0, 5) AS coef FROM k
UNION ALL SELECT 'l_quantity', round(b1, 5) FROM k UNION ALL SELECT 'l_discount', round(b2, 5) FROM k""")
def m1_ols(spark, sf):
    return two_feature(spark, sf).coefficient_table(spark).select("term", F.round("coef", 5).alias("coef"))


@query("m2_predict", f"""WITH {_TWO_SQL}, d AS (SELECT DISTINCT l_quantity, l_discount FROM lineitem)
SELECT l_quantity, l_discount, round(b0 + b1*l_quantity + b2*l_discount, 4) AS prediction FROM d CROSS JOIN k""")
def m2_predict(spark, sf):
    cells = load(spark, sf, "lineitem").select("l_quantity", "l_discount").distinct()
    return two_feature(spark, sf).predict(cells).withColumn("prediction", F.round("prediction", 4))


@query("m3_r_squared", f"""WITH {_TWO_SQL} SELECT n AS n_obs, round(r2, 9) AS r_squared,
 round(1 - (1 - r2) * (n - 1) / (n - 3), 9) AS adjusted_r_squared FROM k""")
def m3_r_squared(spark, sf):
    q = two_feature(spark, sf).quality(spark)
    return q.select("n_obs", F.round("r_squared", 9).alias("r_squared"),
                    F.round("adjusted_r_squared", 9).alias("adjusted_r_squared"))


@query("m4_coefficient_table", f"""WITH {_TWO_SQL}, e AS (SELECT *, sqrt(sig * s22 / det / n) AS e1, sqrt(sig * s11 / det / n) AS e2,
  sqrt(sig * (1 + (m1*m1*s22 - 2*m1*m2*s12 + m2*m2*s11) / det) / n) AS e0 FROM k)
SELECT 'const' AS term, round(b0, 5) AS coef, round(e0, 6) AS std_error, round(b0/e0, 6) AS statistic FROM e
UNION ALL SELECT 'l_quantity', round(b1, 5), round(e1, 6), round(b1/e1, 6) FROM e
UNION ALL SELECT 'l_discount', round(b2, 5), round(e2, 6), round(b2/e2, 6) FROM e""")
def m4_coefficient_table(spark, sf):
    t = two_feature(spark, sf).coefficient_table(spark)
    return t.select("term", F.round("coef", 5).alias("coef"), F.round("std_error", 6).alias("std_error"),
                    F.round("statistic", 6).alias("statistic"))


_HAC_SQL = f"""WITH {PANEL_SQL}, f AS (SELECT regr_slope(value, time) AS b, regr_intercept(value, time) AS a, count(*) AS n,
  avg(time) AS m, regr_sxx(value, time) AS sxx FROM panel),
 e AS (SELECT grp, time AS x, value - a - b*time AS e FROM panel CROSS JOIN f),
 l AS (SELECT x, e, {', '.join(f'lag(e, {j}) OVER w AS e{j}, lag(x, {j}) OVER w AS x{j}' for j in (1, 2, 3))}
  FROM e WINDOW w AS (PARTITION BY grp ORDER BY x)),
 g AS (SELECT sum(e*e) + {' + '.join(f'{2 * (1 - j / 4)}*coalesce(sum(e*e{j}), 0)' for j in (1, 2, 3))} AS g00,
  sum(e*e*x) + {' + '.join(f'{1 - j / 4}*coalesce(sum(e*e{j}*(x + x{j})), 0)' for j in (1, 2, 3))} AS g01,
  sum(e*e*x*x) + {' + '.join(f'{2 * (1 - j / 4)}*coalesce(sum(e*e{j}*x*x{j}), 0)' for j in (1, 2, 3))} AS g11 FROM l),
 i AS (SELECT *, 1.0/n + m*m/sxx AS i00, -m/sxx AS i01, 1/sxx AS i11 FROM f)
SELECT 'const' AS term, round(a, 3) AS coef, round(sqrt(i00*i00*g00 + 2*i00*i01*g01 + i01*i01*g11), 4) AS std_error FROM i, g
UNION ALL SELECT 'time', round(b, 3), round(sqrt(i01*i01*g00 + 2*i01*i11*g01 + i11*i11*g11), 4) FROM i, g"""


@query("m5_newey_west", _HAC_SQL)
def m5_newey_west(spark, sf):
    t = M.robust_table(orders_panel(spark, sf), ["time"], "value", "time", ["group"], lags=3, bucketed=True)
    return t.select("term", F.round("coef", 3).alias("coef"), F.round("std_error", 4).alias("std_error"))


_HAC_ROWS_SQL = """WITH d AS (SELECT o_orderpriority AS grp, o_totalprice AS y, CAST((year(o_orderdate)-1995)*12+month(o_orderdate)-1 AS DOUBLE) AS x,
  o_orderdate, o_orderkey FROM orders), f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, count(*) AS n, avg(x) AS m,
  regr_sxx(y, x) AS sxx FROM d),
 l AS (SELECT x, y - a - b*x AS e, o_orderkey FROM d CROSS JOIN f), g AS (SELECT sum(e*e) AS g00, sum(e*e*x) AS g01, sum(e*e*x*x) AS g11 FROM l),
 i AS (SELECT *, 1.0/n + m*m/sxx AS i00, -m/sxx AS i01, 1/sxx AS i11 FROM f)
SELECT 'const' AS term, round(a, 4) AS coef, round(sqrt(i00*i00*g00 + 2*i00*i01*g01 + i01*i01*g11), 5) AS std_error FROM i, g
UNION ALL SELECT 'x', round(b, 5), round(sqrt(i01*i01*g00 + 2*i01*i11*g01 + i11*i11*g11), 6) FROM i, g"""


@query("m5_robust_errors_on_rows", _HAC_ROWS_SQL)
def m5_robust_errors_on_rows(spark, sf):
    """No lags: heteroskedasticity-robust errors over all order rows, without buckets."""
    rows = load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("grp"), F.col("o_totalprice").alias("y"), month_index("o_orderdate").cast("double").alias("x"))
    t = M.robust_table(rows, ["x"], "y", "x", ["grp"], lags=0)
    const = F.col("term") == "const"
    return t.select("term", F.when(const, F.round("coef", 4)).otherwise(F.round("coef", 5)).alias("coef"),
                    F.when(const, F.round("std_error", 5)).otherwise(F.round("std_error", 6)).alias("std_error"))


@query("m7_semilog", """WITH f AS (SELECT regr_slope(l_extendedprice, ln(l_quantity)) AS b,
 regr_intercept(l_extendedprice, ln(l_quantity)) AS a FROM lineitem), d AS (SELECT DISTINCT l_quantity FROM lineitem)
SELECT l_quantity, round(a + b*ln(l_quantity), 4) AS prediction FROM d CROSS JOIN f""")
def m7_semilog(spark, sf):
    rows = load(spark, sf, "lineitem")
    model = Regression.fit(rows, ["l_quantity"], "l_extendedprice", "semilog")
    return model.predict(rows.select("l_quantity").distinct()).withColumn("prediction", F.round("prediction", 4))


_POWER_SQL = """f AS (SELECT regr_slope(ln(l_quantity), ln(l_extendedprice)) AS b, regr_intercept(ln(l_quantity), ln(l_extendedprice)) AS a,
  min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, avg(l_extendedprice) AS mx, avg(l_quantity) AS my FROM lineitem)"""


def power(spark, sf):
    return Regression.fit(load(spark, sf, "lineitem"), ["l_extendedprice"], "l_quantity", "doublelog")


@query("m8_doublelog", f"""WITH {_POWER_SQL} SELECT s_suppkey,
 round(CASE WHEN s_acctbal > 0 THEN exp(a + b*ln(CASE WHEN s_acctbal > 0 THEN s_acctbal END)) END, 7) AS prediction FROM supplier CROSS JOIN f""")
def m8_doublelog(spark, sf):
    """Every supplier; a balance without a logarithm has no prediction."""
    rows = load(spark, sf, "supplier").select("s_suppkey", F.col("s_acctbal").alias("l_extendedprice"))
    return power(spark, sf).predict(rows).select("s_suppkey", F.round("prediction", 7).alias("prediction"))


def spline(spark, sf):
    return M.SplineModel.fit(load(spark, sf, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice")


@query("m9_additive_splines")
def m9_additive_splines(spark, sf):
    model = spline(spark, sf)
    cells = load(spark, sf, "lineitem").select("l_quantity", "l_discount").distinct()
    return model.predict(cells).withColumn("r_squared", F.lit(model.r_squared))


_CUBIC_SQL = """d AS (SELECT l_quantity AS x, count(*)::DOUBLE AS n, avg(l_extendedprice) AS y FROM lineitem GROUP BY 1),
 q1 AS (SELECT *, x - (SELECT sum(n*x)/sum(n) FROM d) AS a FROM d),
 q2 AS (SELECT *, x*x - (SELECT sum(n*x*x)/sum(n) FROM q1) - a*(SELECT sum(n*x*x*a)/sum(n*a*a) FROM q1) AS b FROM q1),
 q3 AS (SELECT *, x*x*x - (SELECT sum(n*x*x*x)/sum(n) FROM q2) - a*(SELECT sum(n*x*x*x*a)/sum(n*a*a) FROM q2) - b*(SELECT sum(n*x*x*x*b)/sum(n*b*b) FROM q2) AS c FROM q2),
 f AS (SELECT x, (SELECT sum(n*y)/sum(n) FROM q3) + a*(SELECT sum(n*y*a)/sum(n*a*a) FROM q3) + b*(SELECT sum(n*y*b)/sum(n*b*b) FROM q3)
  + c*(SELECT sum(n*y*c)/sum(n*c*c) FROM q3) AS y FROM q3)"""


def cubic(spark, sf):
    """Four basis functions without a penalty span the cubic polynomials."""
    return M.SplineModel.fit(load(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice", lam=0.0, n_splines=4)


@query("m9_one_cell_spline", f"WITH {_CUBIC_SQL} SELECT x AS l_quantity, round(y, 1) AS prediction FROM f")
def m9_one_cell_spline(spark, sf):
    cells = load(spark, sf, "lineitem").select("l_quantity").distinct()
    return cubic(spark, sf).predict(cells).select("l_quantity", F.round("prediction", 1).alias("prediction"))


@query("m10_one_cell_dependence", f"""WITH {_CUBIC_SQL} SELECT x, round(y - (SELECT y FROM f ORDER BY x LIMIT 1), 1) + 0 AS partial FROM f""")
def m10_one_cell_dependence(spark, sf):
    """The term at the whole numbers of its range, from its start."""
    model = cubic(spark, sf)
    grid = model.partial_dependence(spark, "l_quantity", 50)
    start = model.term_expression("l_quantity", F.lit(model.profile.low["l_quantity"]))
    return grid.select(F.round("x", 6).alias("x"), (F.round(F.col("partial") - start, 1) + F.lit(0.0)).alias("partial"))


@query("m10_partial_dependence")
def m10_partial_dependence(spark, sf):
    return spline(spark, sf).partial_dependence(spark, "l_quantity", 50)


@query("m12_spline_elasticity")
def m12_spline_elasticity(spark, sf):
    """Elasticity of the spline model at every quantity, against the mean price there."""
    model = spline(spark, sf)
    cells = load(spark, sf, "lineitem").groupBy("l_quantity").agg(F.avg("l_extendedprice").alias("y"))
    return cells.select("l_quantity", model.elasticity_expression("l_quantity", F.col("l_quantity"), F.col("y")).alias("elasticity"))


@query("m14_spline_responsiveness")
def m14_spline_responsiveness(spark, sf):
    return spline(spark, sf).responsiveness(spark, "l_quantity", 5.0)


@query("m15_spline_report")
def m15_spline_report(spark, sf):
    return spline(spark, sf).variable_report(spark, 50)


@query("m11_marginal_effects", f"""WITH {_POWER_SQL}, g AS (SELECT lo + i*(hi - lo)/99.0 AS x, f.* FROM f CROSS JOIN range(100) r(i))
SELECT round(x, 4) AS x, round(exp(a + b*ln(x)), 7) AS prediction, round(b*exp(a + b*ln(x))/x, 12) AS marginal_effect FROM g""")
def m11_marginal_effects(spark, sf):
    g = power(spark, sf).grid(spark, "l_extendedprice", 100)
    return g.select(F.round("x", 4).alias("x"), F.round("prediction", 7).alias("prediction"),
                    F.round("marginal_effect", 12).alias("marginal_effect"))


@query("m12_elasticity", f"""WITH {_TWO_SQL}, d AS (SELECT l_quantity, avg(l_extendedprice) AS y FROM lineitem GROUP BY 1)
SELECT l_quantity, round(b1 * l_quantity / y, 9) AS elasticity FROM d CROSS JOIN k""")
def m12_elasticity(spark, sf):
    model = two_feature(spark, sf)
    cells = load(spark, sf, "lineitem").groupBy("l_quantity").agg(F.avg("l_extendedprice").alias("y"))
    value = model.elasticity_expression("l_quantity", F.col("l_quantity"), F.col("y"))
    return cells.select("l_quantity", F.round(value, 9).alias("elasticity"))


@query("m13_saturation", f"""WITH {_POWER_SQL}, g AS (SELECT lo + i*(hi - lo)/99.0 AS x, f.* FROM f CROSS JOIN range(100) r(i)),
 e AS (SELECT x, b, abs(b*exp(a + b*ln(x))/x) AS me FROM g), t AS (SELECT max(me) AS top FROM e)
SELECT 'l_extendedprice' AS variable, 'doublelog' AS model, round(min(x), 4) AS x_min, round(max(x), 4) AS x_max,
 round(max(top), 10) AS max_abs_marginal_effect, round(min(x) FILTER (WHERE me <= 0.01*top), 4) AS saturation_x,
 coalesce(max(b) > 0 AND max(b) < 1, false) AS diminishing_returns FROM e CROSS JOIN t""")
def m13_saturation(spark, sf):
    s = power(spark, sf).saturation(spark, "l_extendedprice", 100)
    return s.select("variable", "model", F.round("x_min", 4).alias("x_min"), F.round("x_max", 4).alias("x_max"),
                    F.round("max_abs_marginal_effect", 10).alias("max_abs_marginal_effect"),
                    F.round("saturation_x", 4).alias("saturation_x"), "diminishing_returns")


@query("m14_responsiveness", f"""WITH {_POWER_SQL} SELECT 'l_extendedprice' AS variable, round(mx, 4) AS base_x_mean,
 round(my, 6) AS base_y_mean, 5.0::DOUBLE AS percentage_change_x, round(0.05*mx, 5) AS absolute_x_change,
 round(b*exp(a + b*ln(mx))*0.05, 9) AS absolute_y_effect, round(b*exp(a + b*ln(mx))*0.05/my*100, 8) AS percentage_y_effect FROM f""")
def m14_responsiveness(spark, sf):
    r = power(spark, sf).responsiveness(spark, "l_extendedprice", 5.0)
    digits = {"base_x_mean": 4, "base_y_mean": 6, "absolute_x_change": 5, "absolute_y_effect": 9, "percentage_y_effect": 8}
    return r.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("m15_variable_report", f"""WITH {_TWO_SQL} SELECT 'l_quantity' AS variable, round(b1, 5) AS marginal_effect,
 round(abs(b1), 5) AS max_abs_marginal_effect, round(m1, 6) AS base_x_mean, round(b1*0.01*m1, 6) AS absolute_y_effect,
 round(b1*0.01*m1/my*100, 9) AS percentage_y_effect, 1.0::DOUBLE AS x_min, 50.0::DOUBLE AS x_max FROM k
UNION ALL SELECT 'l_discount', round(b2, 5), round(abs(b2), 5), round(m2, 6), round(b2*0.01*m2, 6), round(b2*0.01*m2/my*100, 9),
 0.0, 0.1 FROM k""")
def m15_variable_report(spark, sf):
    report = two_feature(spark, sf).variable_report(spark, 50)
    digits = {"marginal_effect": 5, "max_abs_marginal_effect": 5, "base_x_mean": 6, "absolute_y_effect": 6,
              "percentage_y_effect": 9, "x_min": 4, "x_max": 4}
    return report.select("variable", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query("m16_model_comparison", """WITH p AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem),
 f AS (SELECT regr_r2(y, x) AS r_lin, regr_r2(y, ln(x)) AS r_log, regr_slope(ln(y), ln(x)) AS b, regr_intercept(ln(y), ln(x)) AS a FROM p),
 d AS (SELECT 1 - sum((y - exp(a + b*ln(x)))*(y - exp(a + b*ln(x)))) / (var_pop(y)*count(*)) AS dbl FROM p CROSS JOIN f),
 r AS (SELECT 'linear' AS model, r_lin AS v FROM f UNION ALL SELECT 'semilog', r_log FROM f UNION ALL SELECT 'doublelog', dbl FROM d)
SELECT CAST(row_number() OVER (ORDER BY v DESC, model) AS INTEGER) AS rank, model, round(v, 9) AS r_squared FROM r""")
def m16_model_comparison(spark, sf):
    out = M.compare_models(load(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice")
    return out.withColumn("r_squared", F.round("r_squared", 9))


@query("m16_model_comparison_with_splines")
def m16_model_comparison_with_splines(spark, sf):
    return M.compare_models(load(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice", with_spline=True)


def _gradient_sql(source: str, y: str, out: str, target: str) -> str:
    return f"""{target} AS (SELECT * EXCLUDE (pl, nl, py, ny), CASE WHEN pl IS NULL THEN (ny - {y})/(nl - x)
  WHEN nl IS NULL THEN ({y} - py)/(x - pl) ELSE ((x-pl)*(x-pl)*ny + ((nl-x)*(nl-x) - (x-pl)*(x-pl))*{y} - (nl-x)*(nl-x)*py)
  / ((x-pl)*(nl-x)*(nl-pl)) END AS {out} FROM (SELECT *, lag(x) OVER w AS pl, lead(x) OVER w AS nl, lag({y}) OVER w AS py,
  lead({y}) OVER w AS ny FROM {source} WINDOW w AS (PARTITION BY brand ORDER BY x)))"""


_BRAND_SQL = """q AS (SELECT p_brand AS brand, regr_slope(ln(p_size), ln(p_retailprice)) AS b, regr_intercept(ln(p_size), ln(p_retailprice)) AS a,
  min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY 1),
 curve AS (SELECT brand, lo + i*(hi - lo)/99.0 AS x, exp(a + b*ln(lo + i*(hi - lo)/99.0)) AS y FROM q CROSS JOIN range(100) r(i))"""


def brand_curves(spark, sf):
    """Power-law response curve per brand on a 100-point grid, fitted by one grouped aggregate."""
    from causeway.functions.columns import even_grid

    part = load(spark, sf, "part").select(F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("p"),
                                          F.ln("p_size").alias("ls"), F.ln("p_retailprice").alias("lp"))
    fits = part.groupBy("brand").agg(
        F.regr_slope("ls", "lp").alias("b"), F.regr_intercept("ls", "lp").alias("a"),
        F.min("p").alias("lo"), F.max("p").alias("hi"))
    grid = even_grid(fits, F.col("lo"), F.col("hi"), 100)
    return grid.select("brand", "x", F.exp(F.col("a") + F.col("b") * F.ln("x")).alias("y"))


@query("m17_turning_points", f"""WITH {_BRAND_SQL}, {_gradient_sql('curve', 'y', 'd1', 'g1')}, {_gradient_sql('g1', 'd1', 'd2', 'g2')},
 t AS (SELECT brand, quantile_cont(d1, 0.1) AS p10, quantile_cont(d2, 0.05) AS p5, arg_min(x, d1) AS xs, arg_min(x, d2) AS xc FROM g2 GROUP BY 1)
SELECT brand, round(max(xs), 5) AS x_min_slope, round(max(xc), 5) AS x_min_curvature,
 round(min(x) FILTER (WHERE d1 <= p10), 5) AS x_slope_p10, round(min(x) FILTER (WHERE d2 > p5), 5) AS x_curvature_p5
FROM g2 JOIN t USING (brand) GROUP BY 1""")
def m17_turning_points(spark, sf):
    out = M.turning_points(brand_curves(spark, sf), ["brand"], "x", "y")
    return out.select("brand", *[F.round(c, 5).alias(c) for c in
                                 ("x_min_slope", "x_min_curvature", "x_slope_p10", "x_curvature_p5")])


@query("m18_stop_point", f"""WITH {_BRAND_SQL}, {_gradient_sql('curve', 'y', 'd1', 'g1')},
 s AS (SELECT brand, min(x) FILTER (WHERE 100*d1 - 20 <= -18) AS xs FROM g1 GROUP BY 1)
SELECT brand, round(xs, 5) AS x_stop, round(d1, 8) AS effect_at_stop, round(100*d1 - 20, 6) AS net_at_stop
FROM s LEFT JOIN g1 ON s.brand = g1.brand AND x = xs""".replace("SELECT brand, round(xs", "SELECT s.brand, round(xs"))
def m18_stop_point(spark, sf):
    out = M.stop_point(brand_curves(spark, sf), ["brand"], "x", "y", 100.0, 20.0, -18.0)
    return out.select(
        "brand", F.round("x_stop", 5).alias("x_stop"), F.round("effect_at_stop", 8).alias("effect_at_stop"),
        F.round("net_at_stop", 6).alias("net_at_stop"))
