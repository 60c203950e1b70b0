"""Sparse least squares against dense solves, and many levels."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from causeway.functions.columns import OneHot, TooManyLevels
from causeway.operators.its import SegmentedOls, SparseSegmentedFit
from causeway.operators.sparse import fit_sparse, level_table, sparse_one_hot


def made(n=900, levels=(40, 7, 3), seed=2):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({f"c{i}": [f"v{v:03d}" for v in np.minimum(rng.geometric(3 / m, n) - 1, m - 1)] for i, m in enumerate(levels)})
    pdf["const"], pdf["x"] = 1.0, rng.normal(5, 2, n)
    pdf["y"] = 1000 + 2 * pdf.x + pdf.c0.str[1:].astype(int) * 0.3 - (pdf.c1 == "v002") * 4 + rng.normal(size=n)
    return pdf


def dense(pdf, columns):
    parts = [pdf[["const", "x"]].to_numpy()]
    for c in columns:
        parts += [(pdf[c] == v).to_numpy(float)[:, None] for v in sorted(pdf[c].unique())[1:]]
    return np.hstack(parts)


@pytest.mark.parametrize("columns", [["c0"], ["c0", "c1"], ["c0", "c1", "c2"], []])
def test_equals_the_dense_solve(spark, columns):
    pdf = made()
    fit = fit_sparse(spark.createDataFrame(pdf).repartition(4), ["const", "x"], columns, "y")
    z = dense(pdf, columns)
    b, *_ = np.linalg.lstsq(z, pdf.y, rcond=None)
    inverse = np.linalg.inv(z.T @ z)
    assert fit.coef == pytest.approx(b[:2], rel=1e-7)
    assert fit.inverse == pytest.approx(inverse[:2, :2], rel=1e-5, abs=1e-9)
    assert fit.sigma2 == pytest.approx(((pdf.y - z @ b) ** 2).sum() / (len(pdf) - z.shape[1]), rel=1e-8)
    want = [v for c in columns for v in sorted(pdf[c].unique())[1:]]
    rows = fit.levels.orderBy("code").collect()
    assert [r.level for r in rows] == want and [r.coef for r in rows] == pytest.approx(b[2:], abs=1e-5)
    got = fit.mean(spark.createDataFrame(pdf.assign(i=range(len(pdf))))).orderBy("i").toPandas()["mean"]
    assert np.allclose(got, z @ b, atol=1e-5)


def test_a_hundred_thousand_levels(spark):
    n = 300_000
    rows = spark.range(n).select(
        F.lit(1.0).alias("const"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 100).alias("x"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), (F.col("id") % 100_000).cast("string"))).alias("c"))
    rows = rows.withColumn("y", 3 * F.col("x") + F.when(F.col("c") == "hot", 7.0).otherwise(F.substring("c", 2, 9).cast("double") / 1000))
    fit = fit_sparse(rows, ["const", "x"], ["c"], "y")
    assert fit.levels.count() > 60_000 and fit.coefficients["x"] == pytest.approx(3.0, abs=1e-6)
    base = fit.coefficients["const"]
    levels = {r.level: r.coef + base for r in fit.levels.filter(F.col("level").isin("l5", "l77777", "l99998")).collect()}
    assert levels["l5"] == pytest.approx(0.005, abs=1e-5) and all(levels[k] == pytest.approx(int(k[1:]) / 1000, abs=1e-5) for k in levels)


def test_collinear_categories_and_edges(spark):
    pdf = made(200, (6, 6))
    pdf["c1"] = pdf.c0  # the same column twice: many solutions, one prediction
    fit = fit_sparse(spark.createDataFrame(pdf), ["const", "x"], ["c0", "c1"], "y")
    z = dense(pdf, ["c0"])
    b, *_ = np.linalg.lstsq(z, pdf.y, rcond=None)
    got = fit.mean(spark.createDataFrame(pdf.assign(i=range(200)))).orderBy("i").toPandas()["mean"]
    assert np.allclose(got, z @ b, atol=1e-4)
    new = spark.createDataFrame([(1.0, 2.0, "never", "seen"), (1.0, 2.0, None, None)], "const double, x double, c0 string, c1 string")
    assert [r["mean"] for r in fit.mean(new).collect()] == pytest.approx([fit.coef @ [1, 2]] * 2)
    with pytest.raises(ValueError, match="no rows"):
        fit_sparse(spark.createDataFrame(pdf).limit(0), ["const"], ["c0"], "y")


def test_sparse_one_hot(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, "a", "y"), (3, None, "z"), (4, "c", None), (5, "b", "y")], "id int, g string, h string")
    out, levels = sparse_one_hot(df, ["g", "h"])
    assert [tuple(r) for r in levels.orderBy("code").collect()] == [(0, "b", 0), (0, "c", 1), (1, "y", 2), (1, "z", 3)]
    assert {r.id: r.active for r in out.collect()} == {1: [0], 2: [2], 3: [3], 4: [1], 5: [0, 2]}
    assert out.columns == ["id", "active"] and level_table(df.limit(0), ["g"]).count() == 0
    many = spark.range(250).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("g"))
    with pytest.raises(TooManyLevels):
        OneHot.fit(many, ["g"])
    assert sparse_one_hot(many, ["g"])[1].count() == 249


@pytest.mark.parametrize("cov_type", ["HAC", "nonrobust"])
def test_segmented_fit_with_many_levels(spark, cov_type):
    """The sparse fit equals the dense one where both can be made, and takes over above the cap."""
    rng = np.random.default_rng(8)
    n = 900
    pdf = pd.DataFrame({"g": ["a", "b"] * (n // 2), "time": np.arange(n) // 2, "shop": [f"s{v}" for v in rng.integers(0, 12, n)], "z": rng.normal(size=n)})
    pdf["value"] = 10 + 0.02 * pdf.time + 5 * (pdf.time >= 200) + pdf.shop.str[1:].astype(int) + 2 * pdf.z + rng.normal(size=n)
    df = spark.createDataFrame(pdf)
    study = SegmentedOls("time", [200], "g")
    plain = study.fit(df, "value", ["shop", "z"], cov_type)
    sparse = study.fit_sparse(df, "value", ["shop", "z"], cov_type)
    a, b = ({r.term: r for r in f.coefficient_table(spark).collect()} for f in (plain, sparse))
    for term, r in b.items():
        assert (r.coef, r.std_error) == (pytest.approx(a[term].coef, rel=1e-6), pytest.approx(a[term].std_error, rel=1e-4))
    one, two = ({(r.g, r.Period): r for r in f.effects().collect()} for f in (plain, sparse))
    assert one.keys() == two.keys() and all(two[k].Effect_mean == pytest.approx(one[k].Effect_mean, abs=1e-5) for k in one)
    assert {r.level: r.coef for r in sparse.level_coefficients().collect()} == {
        t.removeprefix("shop_"): pytest.approx(r.coef, abs=1e-5) for t, r in a.items() if t.startswith("shop_")}
    many = df.withColumn("shop", F.concat("shop", F.lit("_"), (F.col("time") * 7 % 31).cast("string")))
    wide = study.fit(many, "value", ["shop", "z"], cov_type)
    assert isinstance(wide, SparseSegmentedFit) and wide.level_coefficients().count() > 201
    assert wide.coefficients["D_1"] == pytest.approx(5, abs=1.5) and wide.coefficients["z"] == pytest.approx(2, abs=0.3)
