"""Regression with ARMA errors by least squares (Hannan and Rissanen 1982), one fit per group.

Steps: regression on the intervention terms, a long autoregression of its residuals, a second
regression on lagged values and lagged innovations, and a regression on the filtered series.
Each is a grouped cross-product. ``fit_exact`` goes on from there to the maximum of the exact likelihood,
and the order search scores every order by it. Seasonal lags are additive.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from causeway.functions.columns import period_label
from causeway.functions.stats import normal_quantile
from causeway.operators.gram import (
    apply_fit, coefficient_rows, complete_rows, field_list, fit_by, linear_expression, moments_by, moments_from_row, solve,
)
from causeway.operators.its import MIN_ROWS, CandidateChecks, candidate_rows, design, intervention_terms, require_bucketed, validate
from causeway.operators.ordered import row_number
from causeway.operators.statespace import exact_fits, innovations, maximise, polynomials
from causeway.operators.tables import best_candidate
from causeway.operators.windows import difference
from causeway.session import cut_lineage, keep, require_columns

# fixed values: lags of the long autoregression and the default order grid
LONG_LAGS = 4
GRID = {"p": (0, 1, 2, 3), "d": (0, 1, 2), "q": (0, 1, 2, 3), "P": (0, 1, 2), "D": (0, 1), "Q": (0, 1, 2), "s": (0, 12, 30)}
ORDER_COLUMNS = ["p", "d", "q", "seasonal_p", "seasonal_d", "seasonal_q", "s"]


def lag_set(p: int, seasonal: int, period: int) -> list[int]:
    return sorted({*range(1, p + 1), *(period * k for k in range(1, seasonal + 1) if period)})


def _series(by: Sequence[str], time: str):
    return Window.partitionBy(*by).orderBy(time)


def _innovations(rows: DataFrame, by: Sequence[str], time: str, column: str, name: str, m: int = LONG_LAGS) -> DataFrame:
    """Residuals of a long autoregression of ``column``, null where its lags are missing."""
    w = _series(by, time)
    lagged = rows.withColumns({f"_l{i}": F.lag(column, i).over(w) for i in range(1, m + 1)})
    names = [f"_l{i}" for i in range(1, m + 1)]
    fits = fit_by(lagged, names, column, by)
    fitted = apply_fit(lagged, fits, names, by, "_long")
    return fitted.withColumn(name, F.col(column) - F.col("_long")).drop("_long", *names)


@dataclass(frozen=True)
class ArimaFit:
    time: str
    points: tuple[float, ...]
    group: str | None
    target: str
    exog: tuple[str, ...]
    order: tuple[int, int, int]
    seasonal_order: tuple[int, int, int, int]
    by: tuple[str, ...]
    rows: DataFrame | None = field(compare=False, repr=False)
    exog_fits: DataFrame = field(compare=False, repr=False)
    arma_fits: DataFrame | None = field(compare=False, repr=False)
    tail: DataFrame = field(compare=False, repr=False)

    def coefficient_table(self) -> DataFrame:
        """Intervention and covariate coefficients per group (statistic is asymptotically normal)."""
        return coefficient_rows(self.exog_fits, list(self.exog), self.by)

    def predict(self, level: float = 0.95) -> DataFrame:
        """In-sample one-step means, interval and counterfactual (intervention terms at zero)."""
        if self.rows is None:
            raise ValueError("this model was loaded from disk; it forecasts but holds no rows")
        z = normal_quantile(0.5 + level / 2)
        keys = [self.group] if self.group else []
        return self.rows.select(
            *keys, self.time, F.col(self.target), "mean",
            (F.col("mean") - z * F.col("_sigma")).alias("lower"), (F.col("mean") + z * F.col("_sigma")).alias("upper"),
            (F.col("mean") - F.col("_impact")).alias("counterfactual"))

    def effects(self) -> DataFrame:
        """Effect table over the rows that have a one-step prediction."""
        keys = [self.group] if self.group else []
        rows = self.predict().filter(F.col("mean").isNotNull())
        return rows.groupBy(*keys, period_label(F.col(self.time), self.points).alias("Period")).agg(
            F.avg(self.target).alias("Actual_mean"), F.avg("mean").alias("Predicted_mean"),
            F.avg("counterfactual").alias("Counterfactual_mean"),
            F.avg(F.col(self.target) - F.col("counterfactual")).alias("Effect_mean"))


    def forecast(self, future: DataFrame, level: float = 0.95) -> DataFrame:
        """Out-of-sample mean and interval for future rows ([group], time, covariates).

        The last intervention stays on and its row count goes on. A series needs only its last few
        rows: as many as the lags and differences reach back.
        """
        terms = intervention_terms(len(self.points))
        covariates = [c for c in self.exog if c not in terms and c != "const"]
        keys = [self.group] if self.group else []
        require_columns(future, [self.time, *covariates, *keys])
        rows = future if self.group else future.withColumn("_all", F.lit(0))
        by = list(self.by)
        ahead = rows.select(*by, self.time, *[F.col(c).cast("double").alias(c) for c in covariates])
        schema = T.StructType(field_list(ahead, [*by, self.time]) + [
            T.StructField(c, T.DoubleType()) for c in ("mean", "lower", "upper")])
        (p, d, q), (sp, sd, sq, s) = self.order, self.seasonal_order
        ar, ma, delta = lag_set(p, sp, s), lag_set(q, sq, s), _difference_weights(d, sd, s)
        z, time, n_terms, has_const = normal_quantile(0.5 + level / 2), self.time, len(terms), self.exog[-1:] == ("const",)

        def run(key, past, new):
            if past.empty or new.empty:
                return pd.DataFrame({f.name: [] for f in schema})
            past, new = past.sort_values("_ord"), new.sort_values(time)
            beta = np.asarray(past["_b"].iloc[0], dtype=float)
            phi = np.asarray(past["_phi"].iloc[0], dtype=float) if ar or ma else np.zeros(0)
            level_z, noise, shock = list(past["_z"]), list(past["_noise"]), list(past["_shock"])
            count = past["_count"].iloc[-1]
            const = beta[-1] if has_const else 0.0
            mean = np.empty(len(new))
            x = new[covariates].to_numpy(dtype=float)
            for h in range(len(new)):
                n = sum(phi[k] * noise[-i] for k, i in enumerate(ar))
                n += sum(phi[len(ar) + k] * shock[-i] for k, i in enumerate(ma))
                value = n + const - sum(w * level_z[-i] for i, w in enumerate(delta) if i)
                noise.append(n)
                shock.append(0.0)
                level_z.append(value)
                mean[h] = value + beta[n_terms - 2] + beta[n_terms - 1] * (count + h + 1) + x[h] @ beta[n_terms:n_terms + x.shape[1]]
            half = z * past["_sigma"].iloc[-1] * np.sqrt(np.cumsum(_response_weights(phi, ar, ma, delta, len(new)) ** 2))
            out = new[[*by, time]].copy()
            out["mean"], out["lower"], out["upper"] = mean, mean - half, mean + half
            return out

        found = self.tail.groupBy(*by).cogroup(ahead.groupBy(*by)).applyInPandas(run, schema)
        return found.select(*keys, time, "mean", "lower", "upper")

    def save(self, path: str) -> None:
        """Coefficients and the short tail of each series; no training rows."""
        spark = self.exog_fits.sparkSession
        meta = {k: getattr(self, k) for k in ("time", "points", "group", "target", "exog", "order", "seasonal_order", "by")}
        spark.createDataFrame([("arima", json.dumps(meta))], "kind string, meta string").write.mode("overwrite").parquet(f"{path}/meta")
        self.exog_fits.write.mode("overwrite").parquet(f"{path}/exog")
        if self.arma_fits is not None:
            self.arma_fits.write.mode("overwrite").parquet(f"{path}/arma")
        self.tail.write.mode("overwrite").parquet(f"{path}/tail")

    @classmethod
    def load(cls, spark, path: str) -> ArimaFit:
        meta = json.loads(spark.read.parquet(f"{path}/meta").collect()[0]["meta"])
        meta = {k: tuple(v) if isinstance(v, list) else v for k, v in meta.items()}
        has_arma = any(meta["order"][i] for i in (0, 2)) or any(meta["seasonal_order"][i] for i in (0, 2))
        return cls(rows=None, exog_fits=spark.read.parquet(f"{path}/exog"),
                   arma_fits=spark.read.parquet(f"{path}/arma") if has_arma else None,
                   tail=spark.read.parquet(f"{path}/tail"), **meta)


def _difference_weights(d: int, sd: int, s: int) -> np.ndarray:
    """Coefficients of (1 - B)^d (1 - B^s)^D by power of B."""
    out = np.ones(1)
    for step in [1] * d + [s] * (sd if s else 0):
        factor = np.zeros(step + 1)
        factor[0], factor[step] = 1.0, -1.0
        out = np.convolve(out, factor)
    return out


def _response_weights(phi: np.ndarray, ar: Sequence[int], ma: Sequence[int], delta: np.ndarray, h: int) -> np.ndarray:
    """Weights of past shocks in the h-step forecast error."""
    poly = np.zeros(max(ar, default=0) + 1)
    poly[0] = 1.0
    for k, i in enumerate(ar):
        poly[i] = -phi[k]
    full = np.convolve(poly, delta)
    out = np.zeros(h)
    for j in range(h):
        out[j] = 1.0 if j == 0 else sum(phi[len(ar) + k] for k, i in enumerate(ma) if i == j)
        out[j] -= sum(full[i] * out[j - i] for i in range(1, min(j, len(full) - 1) + 1))
    return out


@dataclass(frozen=True)
class ExactArima:
    """Maximum-likelihood fit per group: coefficients with standard errors, in-sample means and effects."""

    time: str
    points: tuple[float, ...]
    group: str | None
    target: str
    exog: tuple[str, ...]
    order: tuple[int, int, int]
    seasonal_order: tuple[int, int, int, int]
    by: tuple[str, ...]
    rows: DataFrame = field(compare=False, repr=False)
    fits: DataFrame = field(compare=False, repr=False)
    params: DataFrame = field(compare=False, repr=False)

    predict = ArimaFit.predict
    effects = ArimaFit.effects

    def coefficient_table(self) -> DataFrame:
        """(group, ord, term, coef, std_error, statistic, loglik) by generalised least squares at the ARMA estimates."""
        k = len(self.exog)
        entries = F.explode(F.array(*[F.struct(
            F.lit(i).alias("ord"), F.lit(t).alias("term"), F.col("beta")[i].alias("coef"),
            F.sqrt(F.greatest(F.col("covariance")[i * k + i], F.lit(0.0))).alias("std_error")) for i, t in enumerate(self.exog)])).alias("e")
        return self.fits.select(*self.by, "loglik", entries).select(
            *self.by, "e.*", F.try_divide("e.coef", "e.std_error").alias("statistic"), "loglik")


@dataclass(frozen=True)
class ItsArima(CandidateChecks):
    """``ItsArima("time", [27, 54], "group").fit(df, "value", (1, 0, 1))``, one row per (group, time)."""

    time: str
    points: Sequence[float]
    group: str | None = None

    def _keyed(self, df: DataFrame, target: str, covariates: Sequence[str]) -> tuple[DataFrame, list[str]]:
        require_columns(df, [self.time, target, *covariates] + ([self.group] if self.group else []))
        by = [self.group] if self.group else ["_all"]
        rows = df if self.group else df.withColumn("_all", F.lit(0))
        return complete_rows(rows, [self.time, target, *covariates, *by]), by

    def fit(self, df: DataFrame, target: str, order: tuple[int, int, int] = (1, 0, 1),
            seasonal_order: tuple[int, int, int, int] = (0, 0, 0, 0), covariates: Sequence[str] = ()) -> ArimaFit:
        """Per-group fit. An undifferenced series gets a constant."""
        points = tuple(sorted(self.points))
        clean, by = self._keyed(df, target, covariates)
        ours = not clean.is_cached
        clean = keep(clean)
        validate(clean, self.time, points, self.group)
        require_bucketed(clean, by, self.time)
        (p, d, q), (sp, sd, sq, s) = order, seasonal_order
        exog = [*intervention_terms(len(points)), *covariates]
        level = d == 0 and (sd == 0 or s == 0)
        base = design(clean, self.time, points, self.group, intercept=False, bucketed=True)
        base = base.withColumns({"_y": F.col(target).cast("double"), **{f"_x{i}": F.col(c).cast("double") for i, c in enumerate(exog)}})
        xs = [f"_x{i}" for i in range(len(exog))]
        moved = difference(base, by, self.time, ["_y", *xs], d, sd, s)

        first = fit_by(moved, xs, "_y", by, intercept=level)
        staged = apply_fit(moved, first, xs, by, "_fit0", intercept=level)
        staged = cut_lineage(staged.withColumn("_n", F.col("_y") - F.col("_fit0")).drop("_fit0"))
        staged = cut_lineage(_innovations(staged, by, self.time, "_n", "_e"))
        if ours:
            clean.unpersist()  # what follows starts from the checkpoint

        ar, ma = lag_set(p, sp, s), lag_set(q, sq, s)
        w = _series(by, self.time)
        arma_fits = None
        if ar or ma:
            names = [f"_n{i}" for i in ar] + [f"_e{i}" for i in ma]
            lagged = staged.withColumns({
                **{f"_n{i}": F.lag("_n", i).over(w) for i in ar}, **{f"_e{i}": F.lag("_e", i).over(w) for i in ma}})
            arma_fits = fit_by(lagged, names, "_n", by, intercept=False)
            slim = arma_fits.select(*[F.col(c).alias(f"_g_{c}") for c in by], F.col("coef").alias("_phi"))
            match = F.col(by[0]).eqNullSafe(F.col(f"_g_{by[0]}"))
            joined = staged.join(slim, match).drop(f"_g_{by[0]}")

            def filtered(column: str) -> Column:
                out = F.col(column)
                for k, i in enumerate(ar):
                    out = out - F.col("_phi")[k] * F.lag(column, i).over(w)
                return out

            shock = F.lit(0.0)
            for k, i in enumerate(ma):
                shock = shock + F.col("_phi")[len(ar) + k] * F.lag("_e", i).over(w)
            ones = F.lit(1.0)
            for k in range(len(ar)):
                ones = ones - F.col("_phi")[k]
            ready = joined.withColumns({
                "_ys": filtered("_y") - shock, "_c": ones if level else F.lit(0.0),
                **{f"{x}s": filtered(x) for x in xs}})
        else:
            ready = staged.withColumns({
                "_ys": F.col("_y"), "_c": F.lit(1.0 if level else 0.0), "_phi": F.lit(None).cast("array<double>"),
                **{f"{x}s": F.col(x) for x in xs}})
        ready = cut_lineage(ready)
        final_x = [f"{x}s" for x in xs] + (["_c"] if level else [])
        final = fit_by(ready, final_x, "_ys", by, intercept=False)
        slim = final.select(
            *[F.col(c).alias(f"_g_{c}") for c in by], F.col("coef").alias("_b"),
            F.sqrt(F.try_divide(F.col("rss"), (F.col("n_obs") - F.col("rank")).cast("double"))).alias("_sigma"))
        joined = ready.join(slim, F.col(by[0]).eqNullSafe(F.col(f"_g_{by[0]}"))).drop(f"_g_{by[0]}")

        def total(columns: Sequence[str]) -> Column:
            return linear_expression([F.col("_b")[k] for k in range(len(columns))], [F.col(c) for c in columns])

        const = F.col("_b")[len(xs)] if level else F.lit(0.0)
        shock_now = F.col("_ys") - total(final_x)
        n_terms = 2 * len(points)
        rows = joined.withColumns({
            "mean": F.col(target) - shock_now,  # the one-step error is the same in levels and differences
            "_impact": total(exog[:n_terms]), "_shock": shock_now,
            "_z": F.col(target) - total(exog), "_noise": F.col("_y") - total(xs) - const,
        })
        reach = max([*ar, *ma, len(_difference_weights(d, sd, s)) - 1, 1])
        back = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(self.time)))
        tail = rows.withColumn("_ord", -back).filter(F.col("_ord") >= -reach).select(
            *by, "_ord", "_b", "_phi", "_z", "_noise", F.coalesce("_shock", F.lit(0.0)).alias("_shock"), "_sigma",
            F.col(exog[n_terms - 1]).cast("double").alias("_count"))
        return ArimaFit(self.time, points, self.group, target, tuple([*exog, *(["const"] if level else [])]),
                        tuple(order), tuple(seasonal_order), tuple(by), rows, final, arma_fits, tail)

    def _candidates(self, df: DataFrame, target: str, frame: DataFrame, covariates: Sequence[str]) -> DataFrame:
        """Each (candidate, group) is a series of its own, so one grouped fit serves all candidates."""
        clean, by = self._keyed(df, target, covariates)
        spread = candidate_rows(clean.select(*by, self.time, target, *covariates), frame, self.time)
        keyed = spread.withColumn("_series", F.struct("candidate", *by).cast("string"))
        effects = ItsArima(self.time, (0.0,), "_series").fit(keyed, target, covariates=covariates).effects()
        names = keyed.groupBy("_series").agg(
            F.first("candidate").alias("candidate"), *[F.first(c).alias(c) for c in by], F.count(F.lit(1)).alias("n_obs"))
        size = names.groupBy("candidate").agg(F.sum("n_obs").alias("_n"))
        return effects.filter("Period != 'Pre-intervention'").join(names, "_series").join(size, "candidate").select(
            "candidate", *by, F.col("_n").alias("n_obs"), F.col("Effect_mean").alias("effect"))

    def fit_exact(self, df: DataFrame, target: str, order: tuple[int, int, int] = (1, 0, 1),
                  seasonal_order: tuple[int, int, int, int] = (0, 0, 0, 0), covariates: Sequence[str] = ()) -> ExactArima:
        """Per-group maximum of the exact likelihood of the differenced series, from the least-squares start."""
        points = tuple(sorted(self.points))
        start = self.fit(df, target, order, seasonal_order, covariates)
        clean, by = self._keyed(df, target, covariates)
        (p, d, q), (sp, sd, sq, s) = order, seasonal_order
        terms = intervention_terms(len(points))
        exog = [*terms, *covariates]
        level = d == 0 and (sd == 0 or s == 0)
        base = design(clean, self.time, points, self.group, intercept=False, bucketed=True)
        xs = [f"_x{i}" for i in range(len(exog))]
        base = base.withColumns({"_y": F.col(target).cast("double"), **{x: F.col(c).cast("double") for x, c in zip(xs, exog, strict=True)}})
        moved = difference(base, by, self.time, ["_y", *xs], d, sd, s).dropna(subset=["_y", *xs])
        if level:
            moved = moved.withColumn("_c", F.lit(1.0))
        columns = ["_y", *xs, *(["_c"] if level else [])]
        series = row_number(moved, by, [F.col(self.time)], "_pos").withColumn("_pos", F.col("_pos") - 1)
        series = cut_lineage(series)
        ar, ma = lag_set(p, sp, s), lag_set(q, sq, s)
        first = series.select(*by).distinct()
        if ar or ma:
            first = first.join(start.arma_fits.select(*by, F.col("coef").alias("point")), by)
        else:
            first = first.withColumn("point", F.array().cast("array<double>"))
        params = cut_lineage(maximise(series, first, by, columns, ar, ma))
        fits = cut_lineage(exact_fits(series, params, by, columns))
        shocks = innovations(series, params, by, columns)
        found = series.join(shocks, [*by, "_pos"]).join(fits.select(*by, "beta", "variance"), by)
        shock = F.col("shock")[0] - linear_expression([F.col("beta")[i] for i in range(len(columns) - 1)],
                                                      [F.col("shock")[i + 1] for i in range(len(columns) - 1)])
        impact = linear_expression([F.col("beta")[i] for i in range(len(terms))], [F.col(c) for c in terms])
        rows = found.select(*by, self.time, target, (F.col(target) - shock).alias("mean"),
                            F.sqrt(F.col("variance") * F.col("spread")).alias("_sigma"), impact.alias("_impact"))
        return ExactArima(self.time, points, self.group, target, (*exog, *(["const"] if level else [])), tuple(order), tuple(seasonal_order),
                          tuple(by), rows, fits, params)

    def search(self, df: DataFrame, target: str, grid: dict[str, Sequence[int]] | None = None,
               covariates: Sequence[str] = ()) -> DataFrame:
        """Order scores per group on pre-intervention rows, without intervention terms, with ``covariates``.

        Coefficients of an order come from cross-products over the rows that are complete in its own lags; all
        (p, q) of one (d, D, s, P, Q) share them. The score is the AIC of the exact likelihood over all
        rows of the differenced series, per row, because differencing leaves different row counts. A
        series too short for the lags of an order gives no score for it.
        """
        unknown = set(grid or {}) - set(GRID)
        if unknown:
            raise ValueError(f"unknown grid keys: {sorted(unknown)}")
        g = GRID | (grid or {})
        clean, by = self._keyed(df, target, covariates)
        names = ["_v0", *[f"_v{i}" for i in range(1, len(covariates) + 1)]]
        pre = clean.filter(F.col(self.time) < min(self.points)).select(
            *by, self.time, *[F.col(c).cast("double").alias(v) for v, c in zip(names, [target, *covariates], strict=True)])
        n = pre.count()
        if n < MIN_ROWS:
            raise ValueError(f"{n} rows before the first intervention, {MIN_ROWS} are needed")
        require_bucketed(pre, by, self.time)
        return self._scores(pre, by, g, names)

    def _scores(self, pre: DataFrame, by: list[str], g: dict, values: list[str]) -> DataFrame:
        """One pipeline for all (d, D, s): every differenced version is a series of its own."""
        kinds = [(d, sd, s) for d in g["d"] for sd, s in sorted({(D if s else 0, s) for D in g["D"] for s in g["s"]})]
        w = _series(by, self.time)
        rows, name = pre, {(0, v): v for v in values}
        for d in range(1, max(g["d"]) + 1):
            rows = rows.withColumns({f"{v}_{d}": F.col(name[d - 1, v]) - F.lag(name[d - 1, v], 1).over(w) for v in values})
            name |= {(d, v): f"{v}_{d}" for v in values}
        versions = []
        for i, (d, sd, s) in enumerate(kinds):
            now = {v: name[d, v] for v in values}
            for k in range(sd):
                rows = rows.withColumns({f"_k{i}_{k}{v}": F.col(now[v]) - F.lag(now[v], s).over(w) for v in values})
                now = {v: f"_k{i}_{k}{v}" for v in values}
            versions.append(F.struct(F.lit(i).alias("_kind"), *[F.col(now[v]).alias(v) for v in values]))
        long = rows.select(*by, self.time, F.explode(F.array(*versions)).alias("_e")).select(*by, self.time, "_e.*").dropna(subset=values)
        keys = ["_kind", *by]
        level = [i for i, (d, sd, _) in enumerate(kinds) if d == 0 and sd == 0]
        long = row_number(long, keys, [F.col(self.time)], "_pos").withColumns({
            "_pos": F.col("_pos") - 1, "_c": F.col("_kind").isin(level).cast("double")})
        long = cut_lineage(long)
        xs = ["_c", *values[1:]]
        staged = apply_fit(long, fit_by(long, xs, "_v0", keys, intercept=False), xs, keys, "_fit", intercept=False)
        staged = cut_lineage(staged.withColumn("_u", F.col("_v0") - F.col("_fit")))
        shocked = cut_lineage(_innovations(staged, keys, self.time, "_u", "_e"))

        each = _series(keys, self.time)
        seasonal = [i for i, kind in enumerate(kinds) if kind[2]]
        depths = F.explode(F.when(F.col("_kind").isin(seasonal), F.array(*[
            F.struct(F.lit(P).alias("_P"), F.lit(Q).alias("_Q")) for P in g["P"] for Q in g["Q"]])).otherwise(
                F.array(F.struct(F.lit(0).alias("_P"), F.lit(0).alias("_Q"))))).alias("_depth")
        lags = {**{f"_a{i}": F.lag("_u", i).over(each) for i in range(1, max(g["p"]) + 1)},
                **{f"_m{i}": F.lag("_e", i).over(each) for i in range(1, max(g["q"]) + 1)}}
        for source, mark, top in (("_u", "_sa", max(g["P"])), ("_e", "_sm", max(g["Q"]))):
            for k in range(1, top + 1):
                value = F.lit(None).cast("double")
                for s in sorted({s for _, _, s in kinds if s}):
                    own = [i for i, kind in enumerate(kinds) if kind[2] == s]
                    value = F.when(F.col("_kind").isin(own), F.lag(source, s * k).over(each)).otherwise(value)
                lags[f"{mark}{k}"] = value
        deep = shocked.withColumns(lags).select("*", depths).select("*", "_depth.*")
        for mark, depth, top in (("_sa", "_P", max(g["P"])), ("_sm", "_Q", max(g["Q"]))):  # lags beyond an order's own aren't asked for
            deep = deep.withColumns({f"{mark}{k}": F.when(F.col(depth) >= k, F.col(f"{mark}{k}")).otherwise(F.lit(0.0)) for k in range(1, top + 1)})
        names = [*lags, "_u"]
        stats = moments_by(deep, names, [*keys, "_P", "_Q"])
        orders = [(p, d, q, P, D, Q, s) for d, D, s in kinds for p in g["p"] for q in g["q"]
                  for P in (g["P"] if s else (0,)) for Q in (g["Q"] if s else (0,))]
        place = {o: i for i, o in enumerate(orders)}
        array = T.ArrayType(T.DoubleType())
        schema = T.StructType(field_list(long, keys) + [T.StructField("candidate", T.LongType()), T.StructField("phi", array), T.StructField("theta", array)])

        def solve_rows(batches):
            for pdf in batches:
                out = []
                for row in pdf.to_dict("records"):
                    m = moments_from_row(row, names)
                    if m.n < MIN_ROWS:
                        continue
                    (d, sd, s), sp, sq = kinds[int(row["_kind"])], int(row["_P"]), int(row["_Q"])
                    for p in g["p"]:
                        for q in g["q"]:
                            ar, ma = lag_set(p, sp, s), lag_set(q, sq, s)
                            use = [f"_a{i}" if i <= p else f"_sa{i // s}" for i in ar] + [f"_m{i}" if i <= q else f"_sm{i // s}" for i in ma]
                            if m.n <= len(use) + 1:
                                continue
                            phi, theta = polynomials(solve(m, use, "_u", False).coef, ar, ma)
                            out.append([row[c] for c in keys] + [place[p, d, q, sp, sd, sq, s], phi.tolist(), theta.tolist()])
                yield pd.DataFrame(out, columns=[f.name for f in schema])

        params = cut_lineage(stats.mapInPandas(solve_rows, schema))
        fits = exact_fits(long, params, keys, ["_v0", *xs])
        n_x = len(values) - 1
        sizes = [len(lag_set(p, P, s)) + len(lag_set(q, Q, s)) + n_x + (d == 0 and D == 0) + 1 for p, d, q, P, D, Q, s in orders]
        named = pre.sparkSession.createDataFrame(
            [(i, *o, k) for i, (o, k) in enumerate(zip(orders, sizes, strict=True))],
            "candidate bigint, " + ", ".join(f"{c} int" for c in ORDER_COLUMNS) + ", _k int")
        return fits.join(F.broadcast(named), "candidate").filter(F.col("n") > F.col("_k")).select(
            *by, *ORDER_COLUMNS, F.col("n").alias("n_obs"), ((2 * F.col("_k") - 2 * F.col("loglik")) / F.col("n")).alias("aic"))

    def best_order(self, scores: DataFrame) -> tuple[tuple[int, int, int], tuple[int, int, int, int]]:
        """One order for all groups: smallest mean score."""
        means = scores.groupBy(*ORDER_COLUMNS).agg(F.avg("aic").alias("aic"))
        r = best_candidate(means, ORDER_COLUMNS, "aic").collect()[0]
        if r["p"] is None:
            raise ValueError("no order could be scored")
        return (r["p"], r["d"], r["q"]), (r["seasonal_p"], r["seasonal_d"], r["seasonal_q"], r["s"])
