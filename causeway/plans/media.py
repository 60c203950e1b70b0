"""Media-mix queries on daily events."""

from __future__ import annotations

from pyspark.sql import functions as F

from causeway.operators import media as X
from causeway.operators.ordered import row_number
from causeway.operators.tables import last_periods_split, metric_table
from causeway.plans.common import MEDIA_SQL, carried_sql, media_daily, sales_daily
from causeway.plans.registry import query

# parameters of every channel of the table, from its data and its place in the order of names
_PARAMS_SQL = """params AS (SELECT channel, 0.2::DOUBLE + 0.15::DOUBLE*(row_number() OVER o % 4) AS decay, avg(x) AS half,
  0.7::DOUBLE + 0.3::DOUBLE*(row_number() OVER o % 4) AS slope, (SELECT sum(sales)/count(DISTINCT d) FROM ads) / count(*) OVER () AS beta,
  sum(spend)/sum(x) AS price FROM media GROUP BY channel WINDOW o AS (ORDER BY channel))"""

_EFFECT_SQL = f"""WITH RECURSIVE {MEDIA_SQL}, {_PARAMS_SQL}, {carried_sql("p.decay", "JOIN params p ON p.channel = n.channel")},
 stocked AS (SELECT c.*, decay, half, slope, beta, price FROM carried c JOIN params USING (channel)),
 eff AS (SELECT *, beta * pow(stock, slope) / (pow(stock, slope) + pow(half, slope)) AS effect FROM stocked),
 sale AS (SELECT d, sum(sales) AS sales FROM ads GROUP BY 1)"""


def params(spark, sf):
    """Channel parameters: a channel-sized frame."""
    media, sales = media_daily(spark, sf), sales_daily(spark, sf)
    mean = sales.agg((F.sum("sales") / F.count("date")).alias("_sales"))
    own = media.groupBy("channel").agg(F.avg("x").alias("half"), (F.sum("spend") / F.sum("x")).alias("price"))
    placed = row_number(own, [], [F.col("channel")], "_place")
    turn = F.col("_place") % 4
    total = own.agg(F.count(F.lit(1)).alias("_n")).crossJoin(F.broadcast(mean))
    return placed.crossJoin(F.broadcast(total)).select(
        "channel", (0.2 + 0.15 * turn).alias("decay"), "half", (0.7 + 0.3 * turn).alias("slope"),
        (F.col("_sales") / F.col("_n")).alias("beta"), "price")


def effects(spark, sf):
    return X.channel_effects(media_daily(spark, sf), params(spark, sf))


@query("x1_media_fit")
def x1_media_fit(spark, sf):
    _, scores = X.fit_media(media_daily(spark, sf), sales_daily(spark, sf))
    return scores


@query("x1_media_own_shapes")
def x1_media_own_shapes(spark, sf):
    fit, _ = X.fit_media(media_daily(spark, sf), sales_daily(spark, sf), own_shapes=True)
    return fit.params(spark)


@query("x1_media_holdout")
def x1_media_holdout(spark, sf):
    """Fit without the last 28 dates, predict all, and score both parts."""
    media, sales = media_daily(spark, sf), sales_daily(spark, sf)
    split = last_periods_split(sales, "date", 28)
    train = split.filter("NOT is_test")
    fit, _ = X.fit_media(media.join(train.select("date"), "date", "left_semi"), train, own_shapes=True)
    scored = split.join(fit.predict(media), "date")
    return metric_table(scored, F.col("sales"), F.col("predicted"), ["is_test"])


@query("x2_bootstrap_effects")
def x2_bootstrap_effects(spark, sf):
    media, sales = media_daily(spark, sf), sales_daily(spark, sf)
    fit, _ = X.fit_media(media, sales)
    return X.bootstrap_effects(media, sales, fit)


@query("x2_posterior_effects")
def x2_posterior_effects(spark, sf):
    fit, _ = X.fit_media(media_daily(spark, sf), sales_daily(spark, sf), own_shapes=True)
    return X.posterior_effects(X.posterior_draws(spark, fit))


@query("x3_contribution_and_roi", _EFFECT_SQL + """ SELECT channel, round(sum(effect), 5) AS contribution, round(sum(spend), 2) AS spend,
 round(sum(effect) / (SELECT sum(sales) FROM sale), 9) AS share, round(sum(effect) / sum(spend), 9) AS roi FROM eff GROUP BY 1""")
def x3_contribution_and_roi(spark, sf):
    out = X.contribution(effects(spark, sf), sales_daily(spark, sf))
    digits = {"contribution": 5, "spend": 2, "share": 9, "roi": 9}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("x4_response_curves", _EFFECT_SQL + """, r AS (SELECT channel, max(stock) AS high FROM eff GROUP BY 1),
 g AS (SELECT channel, half, slope, beta, i*high/49.0 AS x FROM params JOIN r USING (channel) CROSS JOIN range(50) t(i))
SELECT channel, round(x, 6) AS x, round(CASE WHEN x <= 0 THEN 0 ELSE beta*pow(x, slope)/(pow(x, slope) + pow(half, slope)) END, 6) AS response FROM g""")
def x4_response_curves(spark, sf):
    ranges = effects(spark, sf).groupBy("channel").agg(F.max("stock").alias("high"))
    out = X.response_curves(params(spark, sf), ranges, 50)
    return out.withColumns({c: F.round(c, 6) for c in ("x", "response")})


@query("x5_baseline_split", _EFFECT_SQL + """, m AS (SELECT d, sum(effect) AS media FROM eff GROUP BY 1)
SELECT d AS date, round(sales, 2) AS sales, round(coalesce(media, 0), 5) AS media, round(sales - coalesce(media, 0), 5) AS baseline
FROM sale LEFT JOIN m USING (d)""")
def x5_baseline_split(spark, sf):
    out = X.baseline_split(effects(spark, sf), sales_daily(spark, sf))
    digits = {"sales": 2, "media": 5, "baseline": 5}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


_ENV = ("CASE WHEN {x} <= 0 THEN 0 WHEN slope > 1 AND {x} < touch THEN pow(touch, slope)/(pow(touch, slope)+pow(half, slope))/touch*({x}) "
        "ELSE pow({x}, slope)/(pow({x}, slope)+pow(half, slope)) END")


@query("x6_budget_split", f"""WITH {MEDIA_SQL}, {_PARAMS_SQL}, b AS (SELECT sum(spend) / count(DISTINCT d) AS budget FROM media),
 t AS (SELECT *, half*pow(greatest(slope - 1, 0), 1/slope) AS touch, round(budget, 2)/100 AS size FROM params CROSS JOIN b),
 o AS (SELECT channel, half, slope, beta, price, size, i AS step, beta*(({_ENV.format(x='(i*size/price)')})
   - ({_ENV.format(x='((i-1)*size/price)')})) AS gain FROM t CROSS JOIN range(1, 101) r(i)),
 k AS (SELECT *, row_number() OVER (ORDER BY gain DESC, channel, step) AS place FROM o),
 s AS (SELECT channel, count(*) * max(size) AS spend FROM k WHERE place <= 100 AND gain > 0 GROUP BY 1)
SELECT channel, round(coalesce(spend, 0), 4) AS spend, round(CASE WHEN coalesce(spend, 0) <= 0 THEN 0 ELSE
 beta*pow(spend/price, slope)/(pow(spend/price, slope) + pow(half, slope)) END, 6) AS response FROM params LEFT JOIN s USING (channel)""")
def x6_budget_split(spark, sf):
    """Split the average daily spend of all channels."""
    total = media_daily(spark, sf).agg(F.round(F.sum("spend") / F.count_distinct("date"), 2).alias("b")).first()["b"]
    out = X.budget_split(params(spark, sf), float(total), 100)
    return out.select("channel", F.round("spend", 4).alias("spend"), F.round("response", 6).alias("response"))


@query("x6_budget_split_exact", f"""WITH RECURSIVE {MEDIA_SQL}, {_PARAMS_SQL}, b AS (SELECT round(sum(spend) / count(DISTINCT d), 2) AS budget FROM media),
 o AS (SELECT row_number() OVER (ORDER BY channel) AS i, [CASE WHEN k = 0 THEN 0 ELSE beta*pow(k*budget/100/price, slope)/(pow(k*budget/100/price, slope) + pow(half, slope)) END
   for k in range(101)] AS v FROM params CROSS JOIN b),
 dp AS (SELECT 0::BIGINT AS i, [0.0::DOUBLE for k in range(101)] AS best
  UNION ALL SELECT o.i, [list_max([dp.best[w - k + 1] + o.v[k + 1] for k in range(w + 1)]) for w in range(101)] FROM dp JOIN o ON o.i = dp.i + 1)
SELECT round(best[101], 6) AS response FROM dp ORDER BY i DESC LIMIT 1""")
def x6_budget_split_exact(spark, sf):
    """Best total response to the average daily spend, whatever the curves' shape."""
    total = media_daily(spark, sf).agg(F.round(F.sum("spend") / F.count_distinct("date"), 2).alias("b")).first()["b"]
    return X.exact_budget_split(params(spark, sf), float(total), 100).agg(F.round(F.sum("response"), 6).alias("response"))
