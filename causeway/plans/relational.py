"""Scans, projections, filters, splits, joins, aggregates, sorts and set operations."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from causeway.functions import columns as C
from causeway.operators import tables as R
from causeway.operators.intervals import window_moments
from causeway.operators.its import SegmentedOls, compare_effects
from causeway.operators.regress import Regression
from causeway.plans.common import (
    ADS_SQL, MEDIA_SQL, PANEL_SQL, POINTS, POOLED_SQL, events_ads, media_daily, orders_panel,
)
from causeway.plans.registry import query
from causeway.session import scratch_path
from causeway.sources.tables import load, read_csv


def day(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ---------------------------------------------------------------- scans


@query("s1_csv_scan", """
SELECT c_custkey, c_acctbal, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN NULL
       ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def s1_csv_scan(spark, sf):
    path = scratch_path(spark, "customer-csv")
    segment = F.col("c_mktsegment")
    token = F.when(segment == "BUILDING", "NA").when(segment == "MACHINERY", "N/A").when(segment == "FURNITURE", "")
    load(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", F.coalesce(token, segment).alias("c_mktsegment")
    ).write.option("header", True).csv(path)
    schema = T.StructType().add("c_custkey", "long").add("c_acctbal", "double").add("c_mktsegment", "string")
    return read_csv(spark, path, schema)


@query("s2_table_by_name", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s2_table_by_name(spark, sf):
    return load(spark, sf, "nation")


@query("s3_ad_facts", f"""WITH {ADS_SQL}
SELECT d AS "Date", channel, imp AS "Impressions", spend AS "Spend", sales AS "Sales" FROM ads""")
def s3_ad_facts(spark, sf):
    return events_ads(spark, sf)


# ---------------------------------------------------------------- projections and filters


@query("p1_column_subset", "SELECT l_orderkey, l_quantity FROM lineitem")
def p1_column_subset(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_quantity")


@query("p2_member_and_range", """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice >= 300000""")
def p2_member_and_range(spark, sf):
    return load(spark, sf, "orders").filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_totalprice") >= 300000)
    ).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("p3_or_equalities", """SELECT event_id, event_type FROM events
WHERE event_type = 'click' OR event_type = 'purchase'""")
def p3_or_equalities(spark, sf):
    kind = F.col("event_type")
    return load(spark, sf, "events").filter((kind == "click") | (kind == "purchase")).select("event_id", "event_type")


@query("p4_window_filter", f"""WITH {PANEL_SQL} SELECT grp AS "group", time, n_orders FROM panel
WHERE time BETWEEN 27 - 12 AND 27 + 18""")
def p4_window_filter(spark, sf):
    return orders_panel(spark, sf).filter(F.col("time").between(27 - 12, 27 + 18)).select("group", "time", "n_orders")


@query("p5_half_open_filter", """SELECT o_orderkey FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-04-01' AND o_orderdate < TIMESTAMP '1999-07-01'""")
def p5_half_open_filter(spark, sf):
    at = F.col("o_orderdate")
    return load(spark, sf, "orders").filter((at >= day("1997-04-01")) & (at < day("1999-07-01"))).select("o_orderkey")


@query("p6_derived_column", """SELECT l_orderkey, l_linenumber, 1 AS const,
round(l_extendedprice * (1 - l_discount), 5) AS revenue FROM lineitem""")
def p6_derived_column(spark, sf):
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit(1).alias("const"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 5).alias("revenue"))


@query("p7_drop_level", f"""WITH {ADS_SQL} SELECT d AS "Date", channel, imp AS "Impressions", spend AS "Spend"
FROM ads WHERE channel <> 'error'""")
def p7_drop_level(spark, sf):
    return events_ads(spark, sf).drop("Sales").filter(F.col("channel") != "error")


@query("p8_conditional_overwrite", """SELECT l_orderkey, l_linenumber, l_partkey,
CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS l_quantity FROM lineitem""")
def p8_conditional_overwrite(spark, sf):
    returned = F.col("l_returnflag") == "R"
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(returned, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("l_quantity"))


@query("p9_rename", "SELECT s_suppkey AS supplier, s_acctbal AS balance FROM supplier")
def p9_rename(spark, sf):
    return load(spark, sf, "supplier").select("s_suppkey", "s_acctbal").withColumnsRenamed(
        {"s_suppkey": "supplier", "s_acctbal": "balance"})


@query("p10_value_map", """SELECT l_orderkey, l_linenumber, l_partkey,
CASE l_returnflag WHEN 'A' THEN 0.0::DOUBLE WHEN 'R' THEN 1.0::DOUBLE END AS label FROM lineitem""")
def p10_value_map(spark, sf):
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", C.value_map(F.col("l_returnflag"), {"A": 0.0, "R": 1.0}).alias("label"))


@query("p11_last_periods_split", """
WITH d AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
 r AS (SELECT day, dense_rank() OVER (ORDER BY day DESC) AS k FROM (SELECT DISTINCT day FROM d))
SELECT event_id, day, k <= 10 AS is_test FROM d JOIN r USING (day)""")
def p11_last_periods_split(spark, sf):
    rows = load(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"))
    return R.last_periods_split(rows, "day", 10)


@query("p12_hash_split", """SELECT o_orderkey, o_totalprice,
 CAST('0x' || substr(md5(o_orderkey || ':20'), 1, 8) AS BIGINT) % 100 < 25 AS is_test FROM orders""")
def p12_hash_split(spark, sf):
    return R.hash_split(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), F.col("o_orderkey"))


# ---------------------------------------------------------------- joins


@query("j1_predictions_on_rows", """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, round(a + b * l_quantity, 2) AS prediction
FROM lineitem CROSS JOIN f""")
def j1_predictions_on_rows(spark, sf):
    rows = load(spark, sf, "lineitem")
    model = Regression.fit(rows, ["l_quantity"], "l_extendedprice")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                       F.round(model.expression(), 2).alias("prediction"))


@query("j2_effect_tables_joined", f"""
WITH {POOLED_SQL}, g AS (SELECT grp, p, regr_slope(value, time) AS b, regr_intercept(value, time) AS a FROM seg GROUP BY 1, 2)
SELECT seg.grp AS "group", CASE WHEN seg.p = 0 THEN 'Pre-intervention' ELSE 'Intervention_D_' || seg.p END AS "Period",
       round(avg(value - pre.a0 - pre.b0*time), 3) AS effect_pooled, round(avg(value - g.a - g.b*time), 3) AS effect_grouped
FROM seg CROSS JOIN pre JOIN g ON g.grp = seg.grp AND g.p = 0 GROUP BY 1, 2""")
def j2_effect_tables_joined(spark, sf):
    from causeway.operators.its import effects_per_group

    rows = orders_panel(spark, sf)
    pooled = SegmentedOls("time", POINTS, "group", bucketed=True).fit(rows, "value", cov_type="nonrobust").effects()
    grouped = effects_per_group(rows, "time", POINTS, "value", "group", bucketed=True)
    out = compare_effects({"pooled": pooled, "grouped": grouped}, ["group", "Period"])
    return out.select("group", "Period", *[F.round(c, 3).alias(c) for c in ("effect_pooled", "effect_grouped")])


@query("j3_candidates_by_rows", f"""
WITH {PANEL_SQL}, c AS (SELECT * FROM (VALUES (6.0), (13.0), (20.0)) v(point))
SELECT CAST(point AS DOUBLE) AS point, count(*) AS n, round(regr_slope(value, time), 4) AS slope
FROM panel CROSS JOIN c WHERE time < point GROUP BY 1""")
def j3_candidates_by_rows(spark, sf):
    """Fits on the rows before each candidate point, from one read of the rows."""
    points = [6.0, 13.0, 20.0]
    rows = window_moments(orders_panel(spark, sf), "time", ["value"], [(-math.inf, p, p) for p in points], [])
    n, t, y, tt, ty = (F.col("pre")[i] for i in (0, 1, 3, 4, 6))
    slope = (ty - t * y / n) / (tt - t * t / n)
    at = F.array(*[F.lit(p) for p in points])
    return rows.select(F.get(at, F.col("candidate").cast("int")).alias("point"), n.cast("bigint").alias("n"), F.round(slope, 4).alias("slope"))


_METRICS = """round(avg(abs((y - f) / y)) * 100, 5) AS mape, round(avg(abs(y - f)), 3) AS mae,
       round(sqrt(avg((y - f) * (y - f))), 3) AS rmse"""


@query("j4_train_test_metrics", f"""
WITH {PANEL_SQL}, m AS (SELECT regr_slope(value, n_orders) AS b, regr_intercept(value, n_orders) AS a FROM panel WHERE time < 59),
 e AS (SELECT time >= 59 AS is_test, value AS y, a + b*n_orders AS f FROM panel CROSS JOIN m),
 s AS (SELECT is_test, {_METRICS} FROM e GROUP BY 1)
SELECT metric, max(CASE WHEN NOT is_test THEN v END) AS train, max(CASE WHEN is_test THEN v END) AS test
FROM (SELECT is_test, 'mape' AS metric, mape AS v FROM s UNION ALL SELECT is_test, 'mae', mae FROM s
      UNION ALL SELECT is_test, 'rmse', rmse FROM s) GROUP BY 1""")
def j4_train_test_metrics(spark, sf):
    rows = orders_panel(spark, sf)
    model = Regression.fit(rows.filter("time < 59"), ["n_orders"], "value")
    scored = model.predict(rows).withColumn("is_test", F.col("time") >= 59)
    table = R.metric_table(scored, F.col("value"), F.col("prediction"), ["is_test"])
    long = table.unpivot(["is_test"], ["mape", "mae", "rmse"], "metric", "v")
    digits = F.when(F.col("metric") == "mape", F.round("v", 5)).otherwise(F.round("v", 3))
    return long.groupBy("metric").agg(
        F.max(F.when(~F.col("is_test"), digits)).alias("train"), F.max(F.when(F.col("is_test"), digits)).alias("test"))


# ---------------------------------------------------------------- aggregates


@query("a1_sum_by_two_keys", f"""WITH {ADS_SQL} SELECT d AS "Date", channel, sum(imp) AS impressions,
round(sum(spend), 2) AS spend, round(sum(sales), 2) AS sales FROM ads GROUP BY 1, 2""")
def a1_sum_by_two_keys(spark, sf):
    return events_ads(spark, sf).groupBy("Date", "channel").agg(
        F.sum("Impressions").alias("impressions"), F.round(F.sum("Spend"), 2).alias("spend"),
        F.round(F.sum("Sales"), 2).alias("sales"))


@query("a2_sum_by_one_key", f"""WITH {ADS_SQL} SELECT d AS "Date", round(sum(sales), 2) AS sales FROM ads GROUP BY 1""")
def a2_sum_by_one_key(spark, sf):
    return events_ads(spark, sf).groupBy("Date").agg(F.round(F.sum("Sales"), 2).alias("sales"))


@query("a3_count_list_first", """
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2)
SELECT a.c_nationkey, a."count", b.segments, a.first_value FROM
 (SELECT c_nationkey, count(*) AS "count", arg_min(c_name, c_custkey) AS first_value FROM customer GROUP BY 1) a
 JOIN (SELECT c_nationkey, string_agg(c_mktsegment || ':' || n, ',' ORDER BY c_mktsegment) AS segments FROM c GROUP BY 1) b
 USING (c_nationkey)""")
def a3_count_list_first(spark, sf):
    out = R.group_profile(load(spark, sf, "customer"), "c_nationkey", "c_mktsegment", "c_name", "c_custkey")
    text = F.transform("values", lambda p: F.concat_ws(":", p["value"], p["n"].cast("string")))
    return out.select("c_nationkey", "count", F.array_join(text, ",").alias("segments"), "first_value")


@query("a4_group_means", """SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS quantity,
round(avg(l_extendedprice), 4) AS price, round(avg(l_discount), 8) AS discount, round(avg(l_tax), 8) AS tax
FROM lineitem GROUP BY 1, 2""")
def a4_group_means(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.avg("l_quantity"), 6).alias("quantity"), F.round(F.avg("l_extendedprice"), 4).alias("price"),
        F.round(F.avg("l_discount"), 8).alias("discount"), F.round(F.avg("l_tax"), 8).alias("tax"))


@query("a5_pivot_zero_fill", """SELECT date, coalesce(COLUMNS(* EXCLUDE date), 0) AS '\\0' FROM (
 PIVOT (SELECT CAST(ts AS DATE) AS date, event_type AS channel, 1.0::DOUBLE AS x FROM events WHERE event_type <> 'purchase')
 ON channel USING sum(x) GROUP BY date)""")
def a5_pivot_zero_fill(spark, sf):
    return R.pivot_sum(media_daily(spark, sf), "date", "channel", "x")


@query("a6_weekly_resample", """
WITH w AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, round(sum(o_totalprice), 2) AS value, count(*) AS n
           FROM orders GROUP BY 1)
SELECT week, value, n FROM w WHERE week > (SELECT min(week) FROM w) AND week < (SELECT max(week) FROM w)""")
def a6_weekly_resample(spark, sf):
    weeks = R.resample_weeks(load(spark, sf, "orders"), "o_orderdate",
                             {"value": F.col("o_totalprice"), "n": F.lit(1).cast("bigint")})
    return weeks.withColumn("value", F.round("value", 2))


_DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount")


@query("a7_describe", " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean,
round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
round(quantile_cont({c}, 0.75), 4) AS p75, max({c}) AS max FROM lineitem""" for c in _DESCRIBED))
def a7_describe(spark, sf):
    out = R.describe(load(spark, sf, "lineitem").select(*_DESCRIBED), _DESCRIBED)
    digits = {"mean": 6, "std": 6, "p25": 4, "p50": 4, "p75": 4}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("a8_distinct", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def a8_distinct(spark, sf):
    return load(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct()


@query("a9_price_per_unit", f"""WITH {ADS_SQL} SELECT channel, round(sum(spend) / nullif(sum(imp), 0), 6) AS price
FROM ads GROUP BY 1""")
def a9_price_per_unit(spark, sf):
    return events_ads(spark, sf).groupBy("channel").agg(
        F.round(F.try_divide(F.sum("Spend"), F.sum("Impressions")), 6).alias("price"))


@query("a10_exact_percentile", """SELECT l_returnflag, CAST(p AS DOUBLE) AS p, round(quantile_cont(l_extendedprice, 0.05), 5) AS value
FROM lineitem, (VALUES (0.05)) v(p) GROUP BY 1, 2
UNION ALL SELECT l_returnflag, 0.1, round(quantile_cont(l_extendedprice, 0.1), 5) FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 0.9, round(quantile_cont(l_extendedprice, 0.9), 5) FROM lineitem GROUP BY 1""")
def a10_exact_percentile(spark, sf):
    out = R.exact_percentiles(load(spark, sf, "lineitem"), "l_extendedprice", [0.05, 0.1, 0.9], ["l_returnflag"])
    return out.withColumn("value", F.round("value", 5))


@query("a11_spread", """SELECT o_orderpriority, min(o_totalprice) AS low, max(o_totalprice) AS high,
round(avg(o_totalprice), 4) AS mean, round(stddev_pop(o_totalprice), 4) AS std_pop,
round(stddev_samp(o_totalprice), 4) AS std_samp FROM orders GROUP BY 1""")
def a11_spread(spark, sf):
    v = "o_totalprice"
    return load(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.min(v).alias("low"), F.max(v).alias("high"), F.round(F.avg(v), 4).alias("mean"),
        F.round(F.stddev_pop(v), 4).alias("std_pop"), F.round(F.stddev_samp(v), 4).alias("std_samp"))


_CURVE = "curve AS (SELECT l_quantity AS x, round(avg(l_extendedprice), 2) AS y FROM lineitem GROUP BY 1)"


def quantity_curve(spark, sf):
    return load(spark, sf, "lineitem").groupBy(F.col("l_quantity").alias("x")).agg(
        F.round(F.avg("l_extendedprice"), 2).alias("y"))


@query("a12_argmin", f"""WITH {_CURVE} SELECT x AS x_low, y AS y_low FROM curve ORDER BY y, x LIMIT 1""")
def a12_argmin(spark, sf):
    return quantity_curve(spark, sf).agg(
        F.min_by("x", F.struct("y", "x")).alias("x_low"), F.min("y").alias("y_low"))


@query("a13_first_x_on_grid", f"""WITH {_CURVE} SELECT min(x) FILTER (WHERE y >= 54000) AS x_first,
min(x) FILTER (WHERE y < 0) AS x_never FROM curve""")
def a13_first_x_on_grid(spark, sf):
    return quantity_curve(spark, sf).agg(
        F.min(F.when(F.col("y") >= 54000, F.col("x"))).alias("x_first"),
        F.min(F.when(F.col("y") < 0, F.col("x"))).alias("x_never"))


# ---------------------------------------------------------------- sorts, limits, sets


@query("o1_top_groups", """SELECT o_custkey, count(*) AS "count" FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def o1_top_groups(spark, sf):
    return R.top_groups(load(spark, sf, "orders"), "o_custkey", 5)


@query("o2_head_and_tail", """
(SELECT 'head' AS side, o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 3)
UNION ALL (SELECT 'tail', o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 3)""")
def o2_head_and_tail(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return R.head_and_tail(rows, ["o_totalprice", "o_orderkey"], 3)


@query("o3_drop_ends", f"""WITH {PANEL_SQL}, m AS (SELECT time, sum(n_orders)::BIGINT AS n FROM panel GROUP BY 1)
SELECT time, n FROM m WHERE time > (SELECT min(time) FROM m) AND time < (SELECT max(time) FROM m)""")
def o3_drop_ends(spark, sf):
    months = orders_panel(spark, sf).groupBy("time").agg(F.sum("n_orders").alias("n"))
    return R.drop_ends(months, "time")


@query("o4_preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def o4_preview(spark, sf):
    return load(spark, sf, "orders").orderBy("o_orderkey").limit(10)


@query("o5_best_candidate", f"""
WITH {PANEL_SQL}, c AS (SELECT CAST(k AS INTEGER) AS cut FROM range(10, 70, 5) r(k)),
 s AS (SELECT cut, grp, regr_syy(value, time) FILTER (WHERE time < cut) * (1 - regr_r2(value, time) FILTER (WHERE time < cut))
  + regr_syy(value, time) FILTER (WHERE time >= cut) * (1 - regr_r2(value, time) FILTER (WHERE time >= cut)) AS rss
  FROM panel CROSS JOIN c GROUP BY 1, 2)
SELECT grp AS "group", arg_min(cut, rss) AS cut, round(min(rss) / 1e9, 3) AS rss FROM s GROUP BY 1""")
def o5_best_candidate(spark, sf):
    cuts = spark.range(10, 70, 5).select(F.col("id").cast("int").alias("cut"))
    rows = orders_panel(spark, sf).crossJoin(F.broadcast(cuts))
    t = F.col("time").cast("double")
    sides = [F.when(F.col("time") < F.col("cut"), F.col("value")), F.when(F.col("time") >= F.col("cut"), F.col("value"))]
    rss = sum((F.regr_syy(y, t) * (1 - F.regr_r2(y, t)) for y in sides), F.lit(0.0))
    scored = rows.groupBy("group", "cut").agg(rss.alias("rss"))
    return R.best_candidate(scored, ["cut"], "rss", ["group"]).withColumn("rss", F.round(F.col("rss") / 1e9, 3))


@query("u1_concatenate", """SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance FROM supplier
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer""")
def u1_concatenate(spark, sf):
    one = load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    two = load(spark, sf, "customer").select(
        F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return one.unionByName(two)
