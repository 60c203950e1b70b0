from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from causeway.operators import graph, ordered, tables, windows


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds two thirds of the rows."""
    rng = np.random.default_rng(3)
    keys = ["hot" if u < 0.67 else f"k{int(u * 1000) % 9}" for u in rng.random(3000)]
    rows = [(k, int(t), i, float(v)) for i, (k, t, v) in enumerate(zip(keys, rng.integers(0, 50, 3000), rng.random(3000)))]
    return spark.createDataFrame(rows, "g string, t long, id long, v double")


@pytest.mark.parametrize("parts", [1, 7])
def test_ordered_scan_equals_plain_window(spark, skewed, parts):
    from pyspark.sql import Window

    w = Window.partitionBy("g").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r.id): (r.n, round(r.s, 9)) for r in skewed.select(
        "id", F.count(F.lit(1)).over(w).alias("n"), F.sum("v").over(w).alias("s")).collect()}
    got = ordered.ordered_scan(skewed.repartition(parts), ["g"], [F.col("t"), F.col("id")], {"s": F.col("v")}, "n")
    assert {r.id: (r.n, round(r.s, 9)) for r in got.collect()} == want


def test_ordered_scan_spreads_the_hot_key(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ordered.place(skewed, ["g"], [F.col("t"), F.col("id")])
        blocks = placed.filter("g = 'hot'").agg(F.count_distinct("_block")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert blocks >= 4


def test_exact_percentiles(skewed):
    rows = skewed.toPandas()
    got = {(r.g, r.p): r.value for r in tables.exact_percentiles(skewed, "v", [0.1, 0.5, 1.0], ["g"]).collect()}
    for g, part in rows.groupby("g"):
        for p in (0.1, 0.5, 1.0):
            assert got[(g, p)] == pytest.approx(np.quantile(part.v, p), abs=1e-12)


@pytest.mark.parametrize("n", [1, 2, 9, 19999, 20001, 60000])
def test_exact_percentiles_at_every_size(spark, n):
    """Around the size where brackets start to narrow, with a value that holds a third of the rows."""
    rng = np.random.default_rng(n)
    v = np.where(rng.random(n) < 0.33, 0.5, rng.random(n))
    df = spark.createDataFrame(pd.DataFrame({"v": v})).repartition(3)
    for r in tables.exact_percentiles(df, "v", [0.0, 0.1, 0.25, 0.5, 0.9999, 1.0]).collect():
        assert r.value == pytest.approx(np.quantile(v, r.p), abs=1e-12)


def test_running_rows_shares_ties(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", 3)], "g string, t long")
    out = windows.running_rows(df, ["g"], "t", F.lit(1), "n").collect()
    assert sorted((r.t, r.n) for r in out) == [(1, 1), (2, 3), (2, 3), (3, 4)]


def test_elapsed_null_group_and_no_group(spark):
    df = spark.createDataFrame([("a", 5), ("a", 9), (None, 4)], "g string, t long")
    assert sorted(r.e for r in windows.elapsed(df, ["g"], "t", "e").collect()) == [1, 1, 5]
    assert sorted(r.e for r in windows.elapsed(df, [], "t", "e").collect()) == [1, 2, 6]


def test_gradient_matches_numpy_on_uneven_grid(spark):
    x = np.array([0.0, 1.0, 1.5, 4.0, 4.2, 9.0])
    y = np.sin(x)
    df = spark.createDataFrame([(0, float(a), float(b)) for a, b in zip(x, y)], "k int, x double, y double")
    got = [r.d for r in windows.gradient(df, ["k"], "x", "y", "d").orderBy("x").collect()]
    assert np.allclose(got, np.gradient(y, x), atol=1e-12)


def test_interpolate_matches_numpy(spark):
    x, y = [0.0, 1.0, 3.0], [2.0, 4.0, -1.0]
    df = spark.createDataFrame([(0, a, b) for a, b in zip(x, y)], "k int, x double, y double")
    for q in (-1.0, 0.0, 0.4, 2.5, 3.0, 7.0):
        got = windows.interpolate(df, ["k"], "x", "y", F.lit(q), "v").first().v
        assert got == pytest.approx(np.interp(q, x, y))


def test_hash_split_ignores_partitioning(spark):
    df = spark.range(5000)
    one = {r.id for r in tables.hash_split(df.repartition(3), F.col("id")).filter("is_test").collect()}
    two = {r.id for r in tables.hash_split(df.coalesce(1), F.col("id")).filter("is_test").collect()}
    assert one == two
    assert 0.22 < len(one) / 5000 < 0.28


def test_top_groups_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [r.k for r in tables.top_groups(df, "k", 2).collect()] == ["c", "a"]


def test_group_profile_and_expand(spark):
    df = spark.createDataFrame([("x", "F", "Lee", 2), ("x", "M", "Ada", 1), ("x", "F", "Bo", 3)], "n string, s string, l string, id long")
    out = tables.group_profile(df, "n", "s", "l", "id").withColumn("all", tables.expand_counts(F.col("values"))).first()
    assert (out["count"], out["first_value"], out["all"]) == (3, "Ada", ["F", "F", "M"])


def test_metrics_with_zero_actual(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, f double")
    r = tables.metric_table(df, F.col("y"), F.col("f")).first()
    assert (r.mape, r.mae, r.rmse) == (50.0, 1.0, 1.0)


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "g string, t long, v double")
    assert tables.exact_percentiles(empty, "v", [0.5], ["g"]).count() == 0
    assert ordered.row_number(empty, ["g"], [F.col("t")]).count() == 0
    assert tables.drop_ends(empty, "t").count() == 0


# ---------------------------------------------------------------- schedules and selection


def test_schedule_by_hand(spark):
    """r waits for p (3), t for r (3 + 6), s and u only for q and s."""
    tasks = spark.createDataFrame([("p", 3), ("q", 2), ("r", 6), ("s", 1), ("t", 4), ("u", 5)], "task string, duration long")
    edges = spark.createDataFrame([("p", "r"), ("q", "r"), ("q", "s"), ("r", "t"), ("s", "t"), ("s", "u")], "pred string, task string")
    got = {r.task: (r.start, r.finish) for r in graph.earliest_starts(tasks, edges).collect()}
    assert got == {"p": (0, 3), "q": (0, 2), "r": (3, 9), "s": (2, 3), "t": (9, 13), "u": (3, 8)}


def test_schedule_with_an_unknown_task_is_an_error(spark):
    tasks = spark.createDataFrame([("a", 1)], "task string, duration long")
    for edge in (("a", "b"), ("b", "a")):
        with pytest.raises(ValueError, match="unknown task"):
            graph.earliest_starts(tasks, spark.createDataFrame([edge], "pred string, task string"))


def test_schedule_cycle_is_an_error(spark):
    tasks = spark.createDataFrame([("a", 1), ("b", 1)], "task string, duration long")
    edges = spark.createDataFrame([("a", "b"), ("b", "a")], "pred string, task string")
    with pytest.raises(ValueError, match="cycle"):
        graph.earliest_starts(tasks, edges)


def test_greedy_selection_and_bound(spark):
    """Ratios 2, 1.5, 1, 0.6 under a cap of 11: two are taken, half of the third fits the bound."""
    items = spark.createDataFrame([(1, 8.0, 4.0), (2, 9.0, 6.0), (3, 2.0, 2.0), (4, 3.0, 5.0)], "id long, value double, weight double")
    picked = graph.budget_selection(items, "value", "weight", "id", 11.0)
    assert sorted(r.id for r in picked.filter("selected").collect()) == [1, 2]
    b = graph.selection_bound(picked, "value", "weight", "id", 11.0).first()
    assert (b.value, b.weight, b.n_selected, b.upper_bound) == (17.0, 10.0, 2, 18.0)
