"""Schedules over the lines of an order and budgeted selection of parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from causeway.operators import graph as G
from causeway.operators.choice import exact_selection
from causeway.plans.registry import query
from causeway.sources.tables import load

_TASK_SQL = """tasks AS (SELECT l_orderkey*10 + l_linenumber AS task, sum(l_quantity) AS duration FROM lineitem GROUP BY 1),
 edges AS (SELECT a.task AS pred, b.task AS task FROM (SELECT task, unnest([1, 2]) AS step FROM tasks) a JOIN tasks b ON b.task = a.task + a.step)"""


def line_tasks(spark, sf):
    """Every line of an order waits for the one or two lines before it."""
    lines = load(spark, sf, "lineitem")
    tasks = lines.groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("task")).agg(
        F.sum("l_quantity").alias("duration"))
    ahead = tasks.select(F.col("task").alias("pred"), F.explode(F.array(F.col("task") + 1, F.col("task") + 2)).alias("task"))
    return tasks, ahead.join(tasks.select("task"), "task", "left_semi").select("pred", "task")


_LONGEST_SQL = f"""WITH RECURSIVE {_TASK_SQL}, walk AS (SELECT task, 0.0::DOUBLE AS start FROM tasks
  UNION SELECT e.task, w.start + t.duration FROM walk w JOIN edges e ON e.pred = w.task JOIN tasks t ON t.task = w.task),
 best AS (SELECT task, max(start) AS start FROM walk GROUP BY 1)"""


@query("g1_earliest_starts", _LONGEST_SQL + """ SELECT task, duration, start, start + duration AS finish
FROM best JOIN tasks USING (task)""")
def g1_earliest_starts(spark, sf):
    return G.earliest_starts(*line_tasks(spark, sf))


@query("g1_project_finish", _LONGEST_SQL + """ SELECT task // 10 AS o_orderkey, max(start + duration) AS finish
FROM best JOIN tasks USING (task) GROUP BY 1""")
def g1_project_finish(spark, sf):
    schedule = G.earliest_starts(*line_tasks(spark, sf))
    return G.project_finish(schedule.withColumn("o_orderkey", F.floor(F.col("task") / 10)), ["o_orderkey"])


CAP = 600.0

_PICK_SQL = """pick AS (SELECT p_brand, p_partkey, p_retailprice, p_size,
 sum(p_size::DOUBLE) OVER w AS rw, sum(p_retailprice) OVER w AS rv
 FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_retailprice / p_size DESC, p_partkey ROWS UNBOUNDED PRECEDING))"""


def picked(spark, sf):
    items = load(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice", F.col("p_size").cast("double").alias("p_size"))
    return G.budget_selection(items, "p_retailprice", "p_size", "p_partkey", CAP, ["p_brand"])


@query("g2_budget_selection", f"""WITH {_PICK_SQL} SELECT p_brand, p_partkey, rw AS running_weight,
 round(rv, 2) AS running_value FROM pick WHERE rw <= 600""")
def g2_budget_selection(spark, sf):
    return picked(spark, sf).filter("selected").select(
        "p_brand", "p_partkey", "running_weight", F.round("running_value", 2).alias("running_value"))


@query("g2_selection_bound", f"""WITH {_PICK_SQL}, s AS (SELECT p_brand, coalesce(sum(p_retailprice) FILTER (WHERE rw <= 600), 0) AS v,
  coalesce(sum(p_size::DOUBLE) FILTER (WHERE rw <= 600), 0) AS w, count(*) FILTER (WHERE rw <= 600) AS k,
  arg_min(p_retailprice, rw) FILTER (WHERE rw > 600) AS nv, arg_min(p_size, rw) FILTER (WHERE rw > 600) AS nw FROM pick GROUP BY 1)
SELECT p_brand, k AS n_selected, round(v, 2) AS value, w AS weight,
 round(v + coalesce((600 - w) / nw * nv, 0), 4) AS upper_bound FROM s""")
def g2_selection_bound(spark, sf):
    out = G.selection_bound(picked(spark, sf), "p_retailprice", "p_size", "p_partkey", CAP, ["p_brand"])
    return out.select("p_brand", "n_selected", F.round("value", 2).alias("value"), "weight",
                      F.round("upper_bound", 4).alias("upper_bound"))


@query("g2_exact_selection", """WITH RECURSIVE o AS (SELECT p_brand, p_retailprice AS v, CAST(p_size AS BIGINT) AS s,
  row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS i FROM part),
 dp AS (SELECT DISTINCT p_brand, 0::BIGINT AS i, [0.0::DOUBLE for k in range(601)] AS best FROM part
  UNION ALL SELECT o.p_brand, o.i, [CASE WHEN w >= o.s THEN greatest(dp.best[w + 1], dp.best[w - o.s + 1] + o.v) ELSE dp.best[w + 1] END for w in range(601)]
  FROM dp JOIN o ON o.p_brand = dp.p_brand AND o.i = dp.i + 1)
SELECT p_brand, round(max(best[601]), 2) AS value FROM dp GROUP BY 1""")
def g2_exact_selection(spark, sf):
    """Largest total price within the cap on size, per brand."""
    items = load(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice", F.col("p_size").cast("double").alias("p_size"))
    chosen = exact_selection(items, "p_retailprice", "p_size", "p_partkey", CAP, ["p_brand"])
    return chosen.groupBy("p_brand").agg(F.round(F.sum(F.when(F.col("selected"), F.col("p_retailprice")).otherwise(0.0)), 2).alias("value"))
