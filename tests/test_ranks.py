"""Exact order statistics and interpolation of tables, against numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from causeway.operators.ordered import Margin, _chained
from causeway.operators.ranks import doubles_of, order_statistics, ordered_bits
from causeway.operators.windows import interpolate_points


def test_bits_keep_the_order():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500), [0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324, 1.7e308]])
    bits = ordered_bits(x)
    order = np.argsort(x, kind="stable")
    assert (np.diff(bits[order]) >= 0).all() and ((np.diff(bits[order]) == 0) == (np.diff(x[order]) == 0)).all()
    assert (doubles_of(bits) == x).all()


@pytest.mark.parametrize("kind", ["spread", "ties", "close", "signs"])
def test_every_rank_is_exact(spark, kind):
    rng = np.random.default_rng(2)
    n = 30_000
    x = {"spread": rng.lognormal(0, 20, n), "ties": rng.integers(0, 7, n).astype(float), "close": 1e9 + rng.random(n) * 1e-4,
         "signs": rng.normal(size=n) * rng.choice([1e-300, 1.0, 1e300], n)}[kind]
    g = np.where(rng.random(n) < 0.7, "hot", np.where(rng.random(n) < 0.5, "b", "c"))
    pdf = pd.DataFrame({"g": g, "x": x, "z": np.where(rng.random(n) < 0.2, np.nan, x * 2)})
    df = spark.createDataFrame(pdf).repartition(7)
    probs = [0.0, 0.01, 0.25, 0.5, 0.999, 1.0]
    got = {(r.g, r.column, r.p): r.value for r in order_statistics(df, ["x", "z"], probs, ["g"]).collect()}
    assert len(got) == 3 * 2 * len(probs)
    for name, part in pdf.groupby("g"):
        for c in "xz":
            for p in probs:
                assert got[name, c, p] == pytest.approx(np.quantile(part[c].dropna(), p), rel=1e-9)
    whole = {(r.column, r.p): r.value for r in order_statistics(df, ["x", "z"], probs).collect()}
    assert whole["x", 0.5] == pytest.approx(np.percentile(x, 50), rel=1e-13) and whole["z", 1.0] == np.nanmax(pdf.z)


def test_nulls_few_values_and_none(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 3.0), (None, float("nan")), (None, 5.0)], "g string, x double")
    got = {(r.g, r.p): r.value for r in order_statistics(df, ["x"], [0.25, 0.5], ["g"]).collect()}
    assert got == {("a", 0.25): 1.0, ("a", 0.5): 1.0, (None, 0.25): 3.5, (None, 0.5): 4.0}
    assert order_statistics(df.limit(0), ["x"], [0.5]).collect() == []
    ints = spark.range(11).select(F.col("id").cast("int").alias("x"))
    assert [r.value for r in order_statistics(ints, ["x"], [0.5]).collect()] == [5.0]


# ---------------------------------------------------------------- interpolation


@pytest.mark.parametrize("partitions", [1, 25])
def test_points_on_a_long_curve(spark, partitions):
    """One group has nearly all curve rows and points, spread over many blocks."""
    rng = np.random.default_rng(4)
    n = 5000
    curve = pd.DataFrame({"g": np.where(rng.random(n) < 0.9, "hot", "b"), "x": rng.permutation(n) * 1.0, "y": rng.normal(size=n)})
    points = pd.DataFrame({"id": np.arange(n), "g": np.where(rng.random(n) < 0.9, "hot", "b"), "x": (rng.random(n) * (n + 400) - 200).round(1)})
    points.loc[:50, "x"] = curve.x[:51].to_numpy()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "90")
    try:
        out = interpolate_points(spark.createDataFrame(curve), spark.createDataFrame(points), ["g"], "x", "y", "value")
        got = {r.id: r.value for r in out.collect()}
        assert out.columns == ["id", "g", "x", "value"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for g, own in points.groupby("g"):
        line = curve[curve.g == g].sort_values("x")
        assert [got[i] for i in own.id] == pytest.approx(np.interp(own.x, line.x, line.y), abs=1e-9)


def test_odd_curves_and_points(spark):
    curve = spark.createDataFrame([("a", 1.0, 10.0), ("a", 3.0, 30.0), ("a", 3.0, 50.0), ("a", None, 1.0), ("a", 9.0, None), (None, 2.0, 7.0)], "g string, x double, y double")
    points = spark.createDataFrame([(1, "a", 2.0), (2, "a", 0.0), (3, "a", 99.0), (4, "a", 3.0), (5, "z", 1.0), (6, None, 5.0), (7, "a", None), (8, "a", 2.0), (8, "a", 2.0)],
                                   "id int, g string, x double")
    got = sorted((r.id, r.value) for r in interpolate_points(curve, points, ["g"], "x", "y", "value").collect())
    assert got == [(1, 25.0), (2, 10.0), (3, 40.0), (4, 40.0), (5, None), (6, 7.0), (7, None), (8, 25.0), (8, 25.0)]
    assert interpolate_points(curve, points.limit(0), ["g"], "x", "y", "value").collect() == []
    assert {r.value for r in interpolate_points(curve.limit(0), points, ["g"], "x", "y", "value").collect()} == {None}


def test_values_pass_over_blocks():
    a, b = ("a",), ("b",)
    blocks = [Margin(0, a, a, True, (1.0, 1.0), (2.0, 2.0)), Margin(1, a, a, True, None, None), Margin(4, a, b, False, None, None), Margin(5, b, b, True, (7.0, 7.0), (8.0, 8.0))]
    coming, going = _chained(blocks)
    assert coming == {0: None, 1: (2.0, 2.0), 4: (2.0, 2.0), 5: None}
    assert going == {5: None, 4: (7.0, 7.0), 1: None, 0: None}
