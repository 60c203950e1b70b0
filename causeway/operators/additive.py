"""Additive trend, seasonality and regressor model for interrupted series.

Normal priors in place of sampling: piecewise-linear trend with changepoints over the first 80%
of the history, weekly and yearly Fourier terms where the span allows, intervention regressors.
Numbers therefore differ from a sampler with Laplace priors.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from causeway.functions.columns import period_label
from causeway.operators.gram import collect_gram, complete_rows, ridge, unpack_gram
from causeway.operators.its import (
    MIN_ROWS, CandidateChecks, candidate_rows, carried_design, check_points, design, intervention_terms, period_clock, require_bucketed,
)
from causeway.operators.tables import best_candidate
from causeway.operators.trend import with_trend_interval
from causeway.operators.widefit import WideDesign, WideFit
from causeway.session import keep, require_columns

# fixed values: prior scales and default changepoint count
CHANGEPOINT_SCALE = 0.05
CHANGEPOINTS = 25
SEASON_SCALE = 10.0
REGRESSOR_SCALE = 10.0
TREND_SCALE = 5.0
SCALE_GRID = (0.001, 0.005, 0.02, 0.1, 0.5)
COUNT_GRID = (5, 10, 15, 20, 25)


def _waves(days: np.ndarray, period: float, order: int) -> np.ndarray:
    angles = 2 * np.pi * np.outer(days, np.arange(1, order + 1)) / period
    return np.hstack([np.sin(angles), np.cos(angles)])


def knot_positions(count: int, n_times: int) -> np.ndarray:
    """Evenly spaced changepoints over the first 80% of scaled time [0, 1]."""
    count = min(count, max(int(np.floor(n_times * 0.8)) - 1, 0))
    return np.linspace(0.0, 0.8, count + 1)[1:] if count else np.zeros(0)


def additive_design(regressors: Sequence[str], low: float, high: float, knots: Sequence[float], yearly: int, weekly: int,
                    centre: Sequence[float], scale: Sequence[float]) -> WideDesign:
    knots = np.asarray(knots, dtype=float)
    mid, unit = np.asarray(centre, dtype=float), np.asarray(scale, dtype=float)
    span = (high - low) or 1.0

    def expand(x):
        days = x[:, 0] - low
        t = days / span
        parts = [t[:, None], np.maximum(t[:, None] - knots[None, :], 0.0)]
        if yearly:
            parts.append(_waves(days, 365.25, yearly))
        if weekly:
            parts.append(_waves(days, 7.0, weekly))
        if len(mid):
            parts.append((x[:, 1:] - mid) / unit)
        return np.column_stack(parts)

    blocks = [("trend", 1), ("changepoints", len(knots)), ("yearly", 2 * yearly), ("weekly", 2 * weekly),
              ("regressors", len(mid))]
    return WideDesign(("_day", *regressors), expand, tuple(b for b in blocks if b[1]))


def prior_penalty(d: WideDesign, changepoint_scale: float) -> np.ndarray:
    """1 / scale^2 per column, to be multiplied by the noise variance."""
    scales = {"trend": TREND_SCALE, "changepoints": changepoint_scale, "yearly": SEASON_SCALE,
              "weekly": SEASON_SCALE, "regressors": REGRESSOR_SCALE}
    out = np.zeros(d.size)
    for name, s in d.block_slices().items():
        out[s] = 1.0 / scales[name] ** 2
    return out


def map_fit(gram: np.ndarray, prior: np.ndarray, rounds: int = 4) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior mode with the noise variance re-estimated between solves on the same k x k matrix."""
    n = gram[0, 0]
    sigma2 = float(gram[-1, -1] / n - (gram[0, -1] / n) ** 2) or 1e-6
    for _ in range(rounds):
        coef, inverse, rss = ridge(gram, prior * sigma2 + 1e-9)
        edf = float(np.trace(inverse @ gram[:-1, :-1]))
        sigma2 = max(rss / max(n - edf, 1.0), 1e-12)
    return coef, inverse, sigma2


@dataclass(frozen=True)
class AdditiveFit:
    time: str
    points: tuple[float, ...]
    group: str | None
    target: str
    fit: WideFit
    regressors: tuple[str, ...]
    shape: dict
    rows: DataFrame | None = field(compare=False, repr=False)
    clock: DataFrame | None = field(default=None, compare=False, repr=False)

    def predict(self, df: DataFrame | None = None, counterfactual: bool = False, components: bool = False) -> DataFrame:
        """Rows with mean, lower, upper; the counterfactual sets the intervention regressors to zero."""
        if df is None and self.rows is None:
            raise ValueError("this model was loaded from disk; pass the rows to predict")
        rows = self.rows if df is None else _with_day(
            carried_design(df, self.clock, self.time, self.points, self.group, intercept=False, bucketed=True), self.time)
        if counterfactual:
            rows = rows.withColumns({c: F.lit(0) for c in intervention_terms(len(self.points))})
        return self.fit.predict(rows, components=components)

    def forecast(self, df: DataFrame, level: float = 0.95, replicates: int = 1000, seed: int = 42) -> DataFrame:
        """``df`` with mean and interval; after the training rows the interval holds future slope changes.

        They come as often as changepoints in the training time and with their mean absolute change of slope.
        """
        knots, span = len(self.shape["knots"]), self.shape["high"] - self.shape["low"]
        rows = self.predict(df)
        if not knots or not span:
            return rows.drop("_day")
        part = self.fit.design.block_slices()["changepoints"]
        size = float(np.abs(self.fit.coef[part.start + 1:part.stop + 1]).mean()) * self.fit.scale / span
        noise = float(np.sqrt(self.fit.sigma2)) * self.fit.scale
        return with_trend_interval(rows, self.shape["high"], knots / span, size, noise, level, replicates, seed).drop("_day")

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {k: getattr(self, k) for k in ("time", "points", "group", "target", "regressors", "shape")}
        f = self.fit
        meta["fit"] = {"scale": f.scale, "coef": f.coef.tolist(), "inverse": f.inverse.tolist(), "sigma2": f.sigma2, "n": f.n}
        spark.createDataFrame([("additive", json.dumps(meta))], "kind string, meta string") \
            .write.mode("overwrite").parquet(f"{path}/meta")
        self.clock.write.mode("overwrite").parquet(f"{path}/clock")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> AdditiveFit:
        meta = json.loads(spark.read.parquet(f"{path}/meta").collect()[0]["meta"])
        f = meta.pop("fit")
        meta = {k: tuple(v) if isinstance(v, list) else v for k, v in meta.items()}
        d = additive_design(meta["regressors"], **meta["shape"])
        fit = WideFit(d, meta["target"], 0.0, f["scale"], np.array(f["coef"]), np.array(f["inverse"]), f["sigma2"], f["n"])
        return cls(fit=fit, rows=None, clock=spark.read.parquet(f"{path}/clock"), **meta)

    def effects(self) -> DataFrame:
        if self.rows is None:
            raise ValueError("this model was loaded from disk and holds no rows")
        keys = [self.group] if self.group else []
        both = self.fit.predict(self.rows, prefix="p_")
        zero = {c: F.lit(0) for c in intervention_terms(len(self.points))}
        both = self.fit.predict(both.withColumns(zero), prefix="c_")
        return both.groupBy(*keys, period_label(F.col(self.time), self.points).alias("Period")).agg(
            F.avg(self.target).alias("Actual_mean"), F.avg("p_mean").alias("Predicted_mean"),
            F.avg("c_mean").alias("Counterfactual_mean"),
            F.avg(F.col(self.target) - F.col("c_mean")).alias("Effect_mean"))


def _score_by_candidate(d: WideDesign, coefs: dict[int, np.ndarray], top: float) -> Column:
    expand = d.expand

    @F.pandas_udf("double")
    def score(candidate: pd.Series, *columns: pd.Series) -> pd.Series:
        z = np.column_stack([np.ones(len(candidate)), expand(np.column_stack([c.to_numpy(dtype=float) for c in columns]))])
        picked = np.stack([coefs[c] for c in candidate])
        return pd.Series(np.einsum("ij,ij->i", z, picked) * top)

    return score(F.col("candidate"), *[F.col(c).cast("double") for c in d.columns])


def _with_day(df: DataFrame, time: str) -> DataFrame:
    return df.withColumn("_day", F.col(time).cast("double"))


@dataclass(frozen=True)
class ItsAdditive(CandidateChecks):
    """``ItsAdditive("time", [27, 54], "group").fit(df, "value")`` on one row per (group, time)."""

    time: str
    points: Sequence[float]
    group: str | None = None

    def _prepare(self, df: DataFrame, target: str, covariates: Sequence[str]) -> DataFrame:
        require_columns(df, [self.time, target, *covariates] + ([self.group] if self.group else []))
        clean = complete_rows(df, [self.time, target, *covariates] + ([self.group] if self.group else []))
        require_bucketed(clean, [self.group] if self.group else [], self.time)
        return _with_day(design(clean, self.time, sorted(self.points), self.group, intercept=False, bucketed=True), self.time)

    def _fact_columns(self, target: str, regressors: Sequence[str]) -> list[Column]:
        return [
            F.count(F.lit(1)).alias("n"), F.min("_day").alias("lo"), F.max("_day").alias("hi"),
            F.count_distinct("_day").alias("times"), F.max(F.abs(F.col(target))).alias("top"),
            *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(regressors)],
            *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(regressors)],
        ]

    def _facts(self, rows: DataFrame, target: str, regressors: Sequence[str]):
        return rows.agg(*self._fact_columns(target, regressors)).collect()[0]

    def _design(self, facts, regressors: Sequence[str], knots: np.ndarray) -> WideDesign:
        return additive_design(regressors, **self._shape(facts, regressors, knots))

    def _shape(self, facts, regressors: Sequence[str], knots: np.ndarray) -> dict:
        """Arguments of ``additive_design``, plain values that can be stored."""
        span = facts["hi"] - facts["lo"]
        step = span / max(facts["times"] - 1, 1)
        yearly = 10 if span >= 730 else 0
        weekly = 3 if span >= 14 and step < 7 else 0
        spread = [float(facts[f"s_{i}"] or 0.0) for i in range(len(regressors))]
        binary = [c.startswith("D_") for c in regressors]
        keep = [b or s == 0 for b, s in zip(binary, spread, strict=True)]
        centre = [0.0 if k else float(facts[f"m_{i}"]) for i, k in enumerate(keep)]
        scale = [1.0 if k else s for k, s in zip(keep, spread, strict=True)]
        return {"low": float(facts["lo"]), "high": float(facts["hi"]), "knots": [float(k) for k in knots],
                "yearly": yearly, "weekly": weekly, "centre": centre, "scale": scale}

    def fit(self, df: DataFrame, target: str, covariates: Sequence[str] = (),
            changepoint_scale: float = CHANGEPOINT_SCALE, n_changepoints: int = CHANGEPOINTS) -> AdditiveFit:
        rows = keep(self._prepare(df, target, covariates))
        points = tuple(sorted(self.points))
        regressors = (*intervention_terms(len(points)), *covariates)
        facts = self._facts(rows, target, regressors)
        check_points(points, facts["lo"], facts["hi"])
        top = float(facts["top"] or 1.0)
        shape = self._shape(facts, regressors, knot_positions(n_changepoints, facts["times"]))
        d = additive_design(regressors, **shape)
        gram = collect_gram(d.gram(rows, target, 0.0, top), d.size + 2)
        coef, inverse, sigma2 = map_fit(gram, prior_penalty(d, changepoint_scale))
        fit = WideFit(d, target, 0.0, top, coef, inverse, sigma2, int(gram[0, 0]))
        clock = period_clock(rows, self.time, [self.group] if self.group else [])
        return AdditiveFit(self.time, points, self.group, target, fit, regressors, shape, rows, clock)

    def _candidates(self, df: DataFrame, target: str, frame: DataFrame, covariates: Sequence[str]) -> DataFrame:
        """Cross-products grouped by candidate, one small solve each, one scoring pass.

        Candidates with the same facts share a design and a pass over the rows; scale and centre are
        each candidate's own, so its effect doesn't depend on which others are asked.
        """
        keys = [self.group] if self.group else ["_all"]
        rows = df if self.group else df.withColumn("_all", F.lit(0))
        rows = complete_rows(rows, [self.time, target, *covariates, *keys]).select(*keys, self.time, target, *covariates)
        require_bucketed(rows, keys, self.time)
        series = candidate_rows(rows, frame, self.time).withColumn("_series", F.struct("candidate", *keys).cast("string"))
        timed = design(series, self.time, (0.0,), "_series", intercept=False, bucketed=True).withColumn("_day", F.col(self.time))
        regressors = (*intervention_terms(1), *covariates)
        timed = keep(timed)
        per = timed.groupBy("candidate").agg(*self._fact_columns(target, regressors)).collect()  # candidate-sized
        starts = df.sparkSession.createDataFrame([(r["candidate"], r["lo"]) for r in per], "candidate bigint, _lo double")
        timed = timed.join(F.broadcast(starts), "candidate").withColumn("_day", F.col("_day") - F.col("_lo")).drop("_lo")
        shapes: dict[tuple, list] = {}
        for r in per:
            facts = r.asDict() | {"lo": 0.0, "hi": r["hi"] - r["lo"]}
            own = tuple(facts[c] for c in sorted(facts) if c not in ("candidate", "n"))
            shapes.setdefault(own, []).append(facts)
        out = None
        for members in shapes.values():
            facts = members[0]
            d = self._design(facts, regressors, knot_positions(CHANGEPOINTS, facts["times"]))
            top = float(facts["top"] or 1.0)
            own = timed.filter(F.col("candidate").isin([r["candidate"] for r in members]))
            cells: dict[int, np.ndarray] = {}
            for r in d.gram(own, target, 0.0, top, ["candidate"]).collect():
                cells.setdefault(r["candidate"], np.zeros((d.size + 2) * (d.size + 3) // 2))[r["pos"]] = r["value"]
            coefs = {c: map_fit(unpack_gram(v, d.size + 2), prior_penalty(d, CHANGEPOINT_SCALE))[0] for c, v in cells.items()}
            one = own.filter(F.col(self.time) >= 0).withColumns({c: F.lit(0) for c in intervention_terms(1)}).withColumn(
                "_base", _score_by_candidate(d, coefs, top)).groupBy("candidate", *keys).agg(
                F.avg(F.col(target) - F.col("_base")).alias("effect"))
            out = one if out is None else out.unionByName(one)
        sizes = df.sparkSession.createDataFrame([(r["candidate"], r["n"]) for r in per], "candidate bigint, n_obs bigint")
        return out.join(F.broadcast(sizes), "candidate")

    def search(self, df: DataFrame, target: str, covariates: Sequence[str] = (),
               scales: Sequence[float] = SCALE_GRID, counts: Sequence[int] = COUNT_GRID) -> DataFrame:
        """Cross-validated MAPE per (changepoint_scale, n_changepoints), pre-intervention rows only.

        Intervention regressors are left out. One pass sums cross-products per fold block for the
        union of all changepoint sets; every candidate is a sub-matrix of it.
        """
        first = min(self.points)
        pre = keep(self._prepare(df, target, covariates).filter(F.col(self.time) < first))
        facts = self._facts(pre, target, list(covariates))
        if facts["n"] < MIN_ROWS:
            raise ValueError(f"{facts['n']} rows before the first intervention, {MIN_ROWS} are needed")
        times = facts["times"]
        initial, period, horizon = max(int(times * 0.5), 3), max(int(times * 0.1), 1), max(int(times * 0.2), 2)
        cuts = []
        cut = facts["hi"] - horizon
        while cut >= facts["lo"] + initial:
            cuts.append(float(cut))
            cut -= period
        if not cuts:
            raise ValueError("the pre-intervention series is too short to validate on")
        cuts.sort()
        sets = [knot_positions(c, times) for c in counts]
        d = self._design(facts, list(covariates), np.concatenate(sets))
        place = d.block_slices().get("changepoints", slice(1, 1))
        top = float(facts["top"] or 1.0)
        rows = pre.withColumn("_block", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("_day"))))
        size = d.size + 2
        cells: dict[int, np.ndarray] = {}
        for r in d.gram(rows, target, 0.0, top, ["_block"]).collect():
            cells.setdefault(r["_block"], np.zeros(size * (size + 1) // 2))[r["pos"]] = r["value"]
        fits, start = {}, place.start
        for c, knots in zip(counts, sets, strict=True):
            own = set(range(start, start + len(knots)))
            columns = [j for j in range(d.size) if not place.start <= j < place.stop or j in own]
            start += len(knots)
            index = [0, *[1 + j for j in columns], size - 1]
            for i in range(len(cuts)):
                train = unpack_gram(sum(cells[b] for b in range(i + 1) if b in cells), size)[np.ix_(index, index)]
                for s in scales:
                    coef, _, _ = map_fit(train, prior_penalty(d, s)[columns])
                    full = np.zeros(size - 1)
                    full[index[:-1]] = coef
                    fits[(float(s), int(c), i)] = full
        expand, inputs = d.expand, list(d.columns)

        def score(batches):
            for pdf in batches:
                x, y = pdf[inputs].to_numpy(dtype=float), pdf["_y"].to_numpy()
                z = np.column_stack([np.ones(len(x)), expand(x)])
                out = []
                for (s, c, i), coef in fits.items():
                    mask = (x[:, 0] > cuts[i]) & (x[:, 0] <= cuts[i] + horizon) & (y != 0)
                    err = np.abs((y[mask] - z[mask] @ coef * top) / y[mask])
                    out.append((s, c, float(err.sum()), int(mask.sum())))
                yield pd.DataFrame(out, columns=["changepoint_scale", "n_changepoints", "ape", "n"])

        scored = rows.select(*[F.col(c).cast("double").alias(c) for c in inputs], F.col(target).cast("double").alias("_y")).mapInPandas(
            score, "changepoint_scale double, n_changepoints int, ape double, n bigint")
        return scored.groupBy("changepoint_scale", "n_changepoints").agg(
            F.try_divide(F.sum("ape"), F.sum("n")).alias("mape"))

    def fit_tuned(self, df: DataFrame, target: str, covariates: Sequence[str] = (), **grids) -> AdditiveFit:
        best = best_candidate(self.search(df, target, covariates, **grids),
                              ["changepoint_scale", "n_changepoints"], "mape").collect()[0]
        if best["n_changepoints"] is None:
            raise ValueError("no candidate could be scored")
        return self.fit(df, target, covariates, best["changepoint_scale"], best["n_changepoints"])
