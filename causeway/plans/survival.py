"""Survival queries on customer churn and logistic fits on order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from causeway.functions.columns import ordinal
from causeway.operators import survival as S
from causeway.operators.forest import SurvivalForest
from causeway.operators.logistic import compare_penalties, fit_logistic
from causeway.operators.tables import hash_split, head_and_tail
from causeway.plans.common import SURVIVAL_SQL, customer_survival
from causeway.plans.registry import query
from causeway.sources.tables import load

_FEATURES = ["c_acctbal", "segment", "nation"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("v1_survival_curve", f"""WITH {SURVIVAL_SQL}, c AS (SELECT c_mktsegment, time, count(*) AS m, count(*) FILTER (WHERE event) AS d FROM cust GROUP BY 1, 2),
 r AS (SELECT *, sum(m) OVER (PARTITION BY c_mktsegment ORDER BY time DESC) AS n FROM c)
SELECT c_mktsegment, time, CAST(n AS BIGINT) AS at_risk, d AS events, round(CASE WHEN max(CASE WHEN d = n THEN 1 ELSE 0 END) OVER w = 1 THEN 0
  ELSE exp(sum(CASE WHEN d = n THEN 0 ELSE ln(1 - d / n::DOUBLE) END) OVER w) END, 8) AS survival
FROM r WHERE d > 0 WINDOW w AS (PARTITION BY c_mktsegment ORDER BY time)""")
def v1_survival_curve(spark, sf):
    out = S.survival_curve(customer_survival(spark, sf), "time", "event", ["c_mktsegment"])
    return out.withColumn("survival", F.round("survival", 8))


@query("v2_log_rank", f"""WITH {SURVIVAL_SQL}, c AS (SELECT time, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS m1, count(*) AS m,
  count(*) FILTER (WHERE event AND c_mktsegment = 'BUILDING') AS d1, count(*) FILTER (WHERE event) AS d
  FROM cust WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1),
 r AS (SELECT d1, d::DOUBLE AS d, (sum(m1) OVER w)::DOUBLE AS n1, (sum(m) OVER w)::DOUBLE AS n FROM c WINDOW w AS (ORDER BY time DESC)),
 s AS (SELECT sum(d1)::BIGINT AS o, sum(d*n1/n) AS e, sum(CASE WHEN n > 1 THEN d*(n1/n)*(1 - n1/n)*(n - d)/(n - 1) ELSE 0 END) AS v FROM r)
SELECT o AS observed, round(e, 6) AS expected, round(v, 6) AS variance, round((o - e)*(o - e)/v, 7) AS chi_square FROM s""")
def v2_log_rank(spark, sf):
    out = S.log_rank(customer_survival(spark, sf), "time", "event", "c_mktsegment", "BUILDING", "MACHINERY")
    return out.select("observed", F.round("expected", 6).alias("expected"), F.round("variance", 6).alias("variance"),
                      F.round("chi_square", 7).alias("chi_square"))


@query("v5_concordance", f"""WITH {SURVIVAL_SQL}, c AS (SELECT time, event, -n_orders AS risk FROM cust),
 p AS (SELECT a.risk AS ra, b.risk AS rb FROM c a JOIN c b ON a.event AND (b.time > a.time OR (b.time = a.time AND NOT b.event)))
SELECT count(*) AS comparable, count(*) FILTER (WHERE ra > rb) AS concordant, count(*) FILTER (WHERE ra = rb) AS tied,
 round((count(*) FILTER (WHERE ra > rb) + 0.5*count(*) FILTER (WHERE ra = rb)) / count(*)::DOUBLE, 10) AS concordance FROM p""")
def v5_concordance(spark, sf):
    rows = customer_survival(spark, sf).withColumn("risk", -F.col("n_orders"))
    out = S.concordance(rows, "time", "event", "risk")
    return out.withColumn("concordance", F.round("concordance", 10))


def encoded(spark, sf):
    rows = customer_survival(spark, sf)
    return rows.withColumns({"segment": ordinal(F.col("c_mktsegment"), _SEGMENTS), "nation": F.col("c_nationkey")})


def forest(rows):
    return S.HazardForest.fit(rows, _FEATURES, "time", "event", trees=50, depth=5)


@query("v3_hazard_forest")
def v3_hazard_forest(spark, sf):
    rows = hash_split(encoded(spark, sf), F.col("c_custkey"), 25, 20)
    model = forest(rows.filter(~F.col("is_test")))
    test = rows.filter("is_test")
    scored = test.join(model.risk(test, "c_custkey"), "c_custkey")
    return S.concordance(scored, "time", "event", "risk")


@query("v4_predicted_curves")
def v4_predicted_curves(spark, sf):
    rows = encoded(spark, sf)
    chosen = head_and_tail(rows, ["c_acctbal", "c_custkey"], 3)
    return forest(rows).curves(chosen, "c_custkey")


def survival_forest(rows):
    """1000 trees, split from 10 rows on, 15 rows a leaf, as many levels as those allow."""
    return SurvivalForest.fit(rows, "c_custkey", _FEATURES, "time", "event", trees=1000, min_split=10, min_leaf=15)


@query("v3_survival_forest")
def v3_survival_forest(spark, sf):
    """Concordance of the log-rank forest on held-out customers."""
    rows = hash_split(encoded(spark, sf), F.col("c_custkey"), 25, 20)
    model = survival_forest(rows.filter(~F.col("is_test")))
    test = rows.filter("is_test")
    scored = test.join(model.risk(test, "c_custkey"), "c_custkey")
    return S.concordance(scored, "time", "event", "risk")


@query("v4_forest_curves")
def v4_forest_curves(spark, sf):
    """Curves of six held-out customers at every event time of the others."""
    rows = hash_split(encoded(spark, sf), F.col("c_custkey"), 25, 20)
    chosen = head_and_tail(rows.filter("is_test"), ["c_acctbal", "c_custkey"], 3)
    return survival_forest(rows.filter(~F.col("is_test"))).curves(chosen, "c_custkey")


_LOGIT_FEATURES = ["quantity", "price", "discount", "tax"]


def returned_lines(spark, sf):
    """Two classes of order lines (returned or not) with features of comparable size."""
    rows = load(spark, sf, "lineitem").filter((F.col("l_returnflag") == "R") | (F.col("l_returnflag") == "N"))
    return rows.select(
        (F.col("l_quantity") / 10).alias("quantity"), (F.col("l_extendedprice") / 10000).alias("price"),
        (F.col("l_discount") * 10).alias("discount"), (F.col("l_tax") * 10).alias("tax"),
        (F.col("l_returnflag") == "R").cast("double").alias("returned"))


@query("m19_logistic")
def m19_logistic(spark, sf):
    fit = fit_logistic(returned_lines(spark, sf), _LOGIT_FEATURES, "returned", 1.0)
    return spark.createDataFrame(list(fit.items()), "features string, params double")


@query("m20_penalty_comparison")
def m20_penalty_comparison(spark, sf):
    return compare_penalties(returned_lines(spark, sf), _LOGIT_FEATURES, "returned")


def quantity_bands(spark, sf):
    """Returned or not, with a dummy for each of three bands of quantity: coefficients are the bands' log odds."""
    q = F.col("quantity")
    bands = {"low": q < 1.7, "middle": (q >= 1.7) & (q < 3.4), "high": q >= 3.4}
    return returned_lines(spark, sf).select(*[c.cast("double").alias(n) for n, c in bands.items()], "returned"), list(bands)


_BANDS_SQL = """WITH l AS (SELECT CASE WHEN l_quantity / 10 < 1.7 THEN 'low' WHEN l_quantity / 10 < 3.4 THEN 'middle' ELSE 'high' END AS features,
  avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END) AS p FROM lineitem WHERE l_returnflag IN ('R', 'N') GROUP BY 1)"""


@query("m19_logistic_bands", _BANDS_SQL + " SELECT features, round(ln(p / (1 - p)), 5) AS params FROM l")
def m19_logistic_bands(spark, sf):
    rows, names = quantity_bands(spark, sf)
    fit = fit_logistic(rows, names, "returned")
    return spark.createDataFrame([(f, round(v, 5)) for f, v in fit.items()], "features string, params double")


@query("m20_penalty_comparison_bands", _BANDS_SQL + """ SELECT features, round(ln(p / (1 - p)), 5) AS none,
 round(ln(p / (1 - p)), 5) AS l2_tiny FROM l""")
def m20_penalty_comparison_bands(spark, sf):
    """Without a penalty and with a vanishing one; the default penalty has no closed form."""
    rows, names = quantity_bands(spark, sf)
    return compare_penalties(rows, names, "returned").select("features", F.round("none", 5).alias("none"), F.round("l2_tiny", 5).alias("l2_tiny"))
