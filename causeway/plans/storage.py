"""Model storage and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from causeway.operators.its import SegmentedFit, SegmentedOls
from causeway.plans.common import POINTS, orders_panel
from causeway.plans.registry import ORACLES, query
from causeway.session import scratch_path
from causeway.sources.report import build_report, markdown_table, write_report
from causeway.sources.tables import load


@query("s4_save_model", ORACLES.get("i3_segmented_ols"))
def s4_save_model(spark, sf):
    path = scratch_path(spark, "model")
    SegmentedOls("time", POINTS, "group", bucketed=True).fit(orders_panel(spark, sf), "value").save(spark, path)
    return spark.read.parquet(f"{path}/coefficients").select("term", F.round("coef", 4).alias("coef"))


@query("s5_load_model", ORACLES.get("i5_counterfactual"))
def s5_load_model(spark, sf):
    path = scratch_path(spark, "model")
    rows = orders_panel(spark, sf)
    SegmentedOls("time", POINTS, "group", bucketed=True).fit(rows, "value").save(spark, path)
    model = SegmentedFit.load(spark, path)
    return model.counterfactual(rows, interval=False).select("group", "time", F.round("mean", 3).alias("mean"))


@query("s6_report_table", """WITH t AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1),
 b AS (SELECT 1 AS section, row_number() OVER (ORDER BY o_custkey) + 1 AS ord, '| ' || o_custkey || ' | ' || n || ' | ' || printf('%.2f', round(total, 2)) || ' |' AS line FROM t)
SELECT section, CAST(ord AS BIGINT) AS ord, line FROM b
UNION ALL SELECT 1, 0, '| o_custkey | n | total |' UNION ALL SELECT 1, 1, '| --- | --- | --- |'""")
def s6_report_table(spark, sf):
    """Numbered report lines of a table with a row per customer."""
    totals = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return markdown_table(totals, ["o_custkey"], 1, 2)


@query("s6_report")
def s6_report(spark, sf):
    rows = orders_panel(spark, sf)
    study = SegmentedOls("time", POINTS, "group", bucketed=True)
    fit = study.fit(rows, "value")
    lines = build_report(spark, "Interrupted time series report", [
        ("Coefficients", fit.coefficient_table(spark), ["ord"]),
        ("Effects by period", fit.effects(), ["group", "Period"]),
        ("Placebo tests", study.placebo_per_intervention(rows, "value"), ["real_intervention_index", "placebo_point"]),
    ])
    path = scratch_path(spark, "report")
    write_report(lines, path)
    return spark.read.text(path)
