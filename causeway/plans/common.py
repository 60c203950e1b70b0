"""Frames several queries share, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from causeway.operators.its import panel
from causeway.sources.tables import ad_facts, load

POINTS = (27, 54)


def month_index(date: str) -> Column:
    return ((F.year(date) - 1995) * 12 + F.month(date) - 1).cast("bigint")


def orders_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly order value and count per priority, over all orders."""
    orders = load(spark, sf, "orders")
    return panel(orders, month_index("o_orderdate"), F.sum("o_totalprice"), F.col("o_orderpriority"),
                 {"n_orders": F.count(F.lit(1))})


PANEL_SQL = """panel AS (
  SELECT o_orderpriority AS grp, CAST((year(o_orderdate)-1995)*12+month(o_orderdate)-1 AS BIGINT) AS time,
         sum(o_totalprice) AS value, count(*) AS n_orders
  FROM orders GROUP BY 1, 2)"""

SEGMENT_SQL = PANEL_SQL + """, seg AS (
  SELECT *, CASE WHEN time < 27 THEN 0 WHEN time < 54 THEN 1 ELSE 2 END AS p FROM panel)"""

POOLED_SQL = SEGMENT_SQL + """, fit AS (
  SELECT p, regr_slope(value, time) AS b, regr_intercept(value, time) AS a, count(*) AS n,
         avg(time) AS mt, regr_sxx(value, time) AS sxx FROM seg GROUP BY p),
 pre AS (SELECT b AS b0, a AS a0, n AS n0, mt AS mt0, sxx AS sxx0 FROM fit WHERE p = 0),
 sig AS (SELECT sum((value - a - b*time)*(value - a - b*time))/(count(*) - 6) AS s2 FROM seg JOIN fit USING (p))"""


def events_ads(spark: SparkSession, sf: str) -> DataFrame:
    """Event rows as media facts: one impression per event, its value as spend, purchases as sales."""
    events = load(spark, sf, "events")
    return ad_facts(events.select(
        F.to_date("ts").alias("Date"), F.col("event_type").alias("channel"), F.lit(1.0).alias("Impressions"),
        F.col("value").alias("Spend"),
        F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0).alias("Sales"),
    ))


ADS_SQL = """ads AS (
  SELECT CAST(ts AS DATE) AS d, event_type AS channel, 1.0::DOUBLE AS imp, value AS spend,
         CASE WHEN event_type = 'purchase' THEN value ELSE 0.0::DOUBLE END AS sales FROM events)"""


def media_daily(spark: SparkSession, sf: str) -> DataFrame:
    """(date, channel, x, spend): media channels per day without the sales channel."""
    ads = events_ads(spark, sf).filter(F.col("channel") != "purchase")
    return ads.groupBy(F.col("Date").alias("date"), "channel").agg(
        F.sum("Impressions").alias("x"), F.sum("Spend").alias("spend"))


def sales_daily(spark: SparkSession, sf: str) -> DataFrame:
    return events_ads(spark, sf).groupBy(F.col("Date").alias("date")).agg(F.sum("Sales").alias("sales"))


MEDIA_SQL = ADS_SQL + """, media AS (
  SELECT d, channel, sum(imp) AS x, sum(spend) AS spend FROM ads WHERE channel <> 'purchase' GROUP BY 1, 2)"""


def carried_sql(decay: str, joined: str = "") -> str:
    """Carry-over of ``media`` by recursion over the days of a channel."""
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY d) AS i FROM media),
 carried AS (SELECT *, x::DOUBLE AS stock FROM numbered WHERE i = 1
  UNION ALL SELECT n.*, n.x + {decay}::DOUBLE * c.stock FROM carried c JOIN numbered n ON n.channel = c.channel AND n.i = c.i + 1 {joined})"""


def customer_survival(spark: SparkSession, sf: str) -> DataFrame:
    """Days from a customer's first to last order; churned when the last order is over 180 days old.

    Orders are reduced to one row per customer by a combined aggregate before the join.
    """
    orders = load(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_at"), F.max("o_orderdate").alias("last_at"),
        F.count(F.lit(1)).alias("n_orders"))
    end = load(spark, sf, "orders").agg(F.max("o_orderdate").alias("end_at"))
    customers = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    return customers.join(orders, F.col("c_custkey") == F.col("o_custkey")).crossJoin(F.broadcast(end)).select(
        "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey", "n_orders",
        F.date_diff("last_at", "first_at").cast("bigint").alias("time"),
        (F.date_diff("end_at", "last_at") > 180).alias("event"),
    )


SURVIVAL_SQL = """cust AS (
  SELECT c_custkey, c_acctbal, c_mktsegment, c_nationkey, n_orders,
         date_diff('day', CAST(first_at AS DATE), CAST(last_at AS DATE)) AS time,
         date_diff('day', CAST(last_at AS DATE), CAST(end_at AS DATE)) > 180 AS event
  FROM customer JOIN (SELECT o_custkey, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at, count(*) AS n_orders
                      FROM orders GROUP BY 1) ON c_custkey = o_custkey
  CROSS JOIN (SELECT max(o_orderdate) AS end_at FROM orders))"""
