"""Window fits from interval moments against refits of the rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from causeway.operators.intervals import added, moments_of, window_moments
from causeway.operators.its import SegmentedOls


def rows(n=900, seed=3):
    """Several rows a time and group, gaps, one hot group, a null group."""
    rng = np.random.default_rng(seed)
    g = rng.choice(["hot", "b", None], n, p=[0.8, 0.1, 0.1])
    time = rng.integers(0, 90, n)
    time = np.where((time > 40) & (time < 47), 50, time)
    c = rng.normal(size=n)
    y = 1e6 + 3 * time + 5 * (time >= 45) + 2 * c + np.where(g == "hot", 4, 0) + rng.normal(size=n)
    return pd.DataFrame({"g": g, "time": time.astype(float), "c": c, "value": y})


def design(pdf, lo, hi, point, by):
    own = pdf[(pdf.time >= lo) & (pdf.time < hi)].copy()
    own["g"] = own.g.fillna("?") if by else "all"
    own["t"] = own.time - own.groupby("g").time.transform("min") + 1
    own["w"] = 0.0
    for _, part in own[own.time >= point].groupby("g"):
        own.loc[part.index, "w"] = [float((part.time <= t).sum()) for t in part.time]
    return own


WINDOWS = [(-math.inf, 90.0, 45.0), (10.0, 60.0, 20.5), (0.0, 30.0, 10.0), (30.0, 91.0, 80.0), (20.0, 21.0, 20.5), (200.0, 300.0, 250.0), (42.0, 48.0, 44.0)]


@pytest.mark.parametrize("by", [["g"], []])
def test_window_moments_equal_refits(spark, by):
    pdf = rows()
    df = spark.createDataFrame(pdf.to_dict("records"), "g string, time double, c double, value double").repartition(6)
    found = window_moments(df, "time", ["c", "value"], WINDOWS, by)
    sums = {r.candidate: r for r in added(found, ["pre", "post"], 15, ["candidate", "at"]).collect()}
    assert set(sums) == {i for i, w in enumerate(WINDOWS) if len(design(pdf, *w, by))}
    for i, w in enumerate(WINDOWS):
        own = design(pdf, *w, by)
        if not len(own):
            continue
        for side, part in (("pre", own[own.time < w[2]]), ("post", own[own.time >= w[2]])):
            m = moments_of(sums[i][side], ["t", "w", "c", "value"], sums[i].at)
            assert m.n == len(part)
            if len(part):
                z = part[["t", "w", "c", "value"]].to_numpy()
                assert np.allclose(m.mean, z.mean(0), rtol=1e-12, atol=1e-9)
                assert np.allclose(m.cov, np.cov(z.T, bias=True).reshape(4, 4), rtol=1e-8, atol=1e-7)


def test_many_candidates_equal_single_fits(spark):
    """1000 windows at once give what each gives alone; with a covariate and several rows a time."""
    pdf = rows(600, 5)
    df = spark.createDataFrame(pdf.to_dict("records"), "g string, time double, c double, value double").cache()
    study = SegmentedOls("time", [45], "g")
    rng = np.random.default_rng(1)
    plan = [(float(a), float(a + 25 + d), float(a + 10 + e)) for a, d, e in zip(rng.integers(0, 50, 1000), rng.integers(0, 15, 1000), rng.integers(0, 8, 1000), strict=True)]
    effects = {(r.candidate, r.g): r for r in study._candidates(df, "value", study._frame(spark, plan), ["c"]).collect()}
    for i in (0, 17, 500, 999):
        own = design(pdf, *plan[i], ["g"])
        post = own.time >= plan[i][2]
        x = np.column_stack([np.ones(len(own)), own.t, post, own.w, own.c])
        b, *_ = np.linalg.lstsq(x, own.value, rcond=None)
        for g, part in own[post].groupby("g"):
            want = (part.value - b[0] - b[1] * part.t - b[4] * part.c).mean()
            got = effects[i, None if g == "?" else g]
            assert got.effect == pytest.approx(want, abs=1e-5) and got.n_obs == len(own)
    df.unpersist()


def test_rows_are_read_once_whatever_the_candidates(spark, tmp_path):
    """The plan over the rows holds one scan and no join with the candidates."""
    spark.createDataFrame(rows().to_dict("records"), "g string, time double, c double, value double").write.parquet(str(tmp_path / "r"))
    study = SegmentedOls("time", [45], "g")
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    df = spark.read.parquet(str(tmp_path / "r"))
    watched = df.mapInPandas(counted, df.schema)
    plan = [(0.0, 80.0, float(p)) for p in range(5, 75)] * 3
    assert len(study._candidates(watched, "value", study._frame(spark, plan), []).select("candidate").distinct().collect()) == len(plan)
    assert seen.value <= 2 * df.count()  # the range partitioning samples its input
