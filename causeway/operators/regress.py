"""Linear, semi-log, double-log and spline regression with effects and saturation points."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from causeway.functions.columns import even_grid
from causeway.operators.gram import (
    NATIVE_LIMIT, TERM_SCHEMA, Solution, collect_gram, complete_rows, linear_expression, moment_columns,
    moments, moments_from_row, newey_west, ridge, solve, term_rows, wide_gram,
)
from causeway.session import require_columns

KINDS = ("linear", "semilog", "doublelog")


@dataclass(frozen=True)
class Profile:
    """Raw-scale training facts a fitted model keeps: means and ranges, not rows."""

    mean: dict[str, float]
    low: dict[str, float]
    high: dict[str, float]


class EffectReports:
    """Elasticity, responsiveness and the report of all variables, for any model with a profile of its training
    rows, ``marginal_effect``, ``effect_expression`` and ``saturation``."""

    def elasticity(self, variable: str, x: float, y: float) -> float:
        if y == 0:
            raise ValueError("elasticity is undefined at y = 0")
        return self.marginal_effect(variable, x) * x / y

    def elasticity_expression(self, variable: str, x: Column, y: Column) -> Column:
        return F.try_divide(self.effect_expression(variable, x) * x, y)

    def responsiveness(self, spark: SparkSession, variable: str, percent: float = 1.0) -> DataFrame:
        """Change of y for a percent change of x around the means."""
        x, y = self.profile.mean[self._known(variable)], self.profile.mean[self.target]
        step = percent / 100.0 * x
        change = self.marginal_effect(variable) * step
        return spark.createDataFrame(
            [(variable, x, y, float(percent), step, change, change / y * 100.0 if y else None)],
            "variable string, base_x_mean double, base_y_mean double, percentage_change_x double, "
            "absolute_x_change double, absolute_y_effect double, percentage_y_effect double")

    def variable_report(self, spark: SparkSession, n: int = 50) -> DataFrame:
        """Effect at the mean, saturation and responsiveness of every variable."""
        out = None
        for v in self.features:
            one = self.saturation(spark, v, n).crossJoin(
                self.responsiveness(spark, v).select("base_x_mean", "base_y_mean", "absolute_y_effect", "percentage_y_effect")
            ).withColumn("marginal_effect", F.lit(self.marginal_effect(v)))
            out = one if out is None else out.unionByName(one)
        return out

    def _known(self, variable: str) -> str:
        if variable not in self.features:
            raise ValueError(f"variable {variable!r} is not in the model")
        return variable


@dataclass(frozen=True)
class Regression(EffectReports):
    """Fitted linear, semi-log (y ~ ln x) or double-log (ln y ~ ln x) model."""

    kind: str
    features: tuple[str, ...]
    target: str
    solution: Solution
    profile: Profile

    # ---- fit

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str], target: str, kind: str = "linear") -> Regression:
        """One aggregate gives cross-products, ranges and the positivity check together."""
        return fit_all(df, features, target, (kind,))[kind]

    @property
    def intercept(self) -> float:
        return float(self.solution.coef[0])

    @property
    def slopes(self) -> dict[str, float]:
        return {f: float(c) for f, c in zip(self.features, self.solution.coef[1:], strict=True)}

    # ---- predict and quality

    def expression(self, at: dict[str, Column] | None = None) -> Column:
        """Prediction as a column expression; ``at`` replaces features by other columns."""
        source = {f: F.col(f"`{f}`") for f in self.features} | (at or {})
        values = [source[f].cast("double") for f in self.features]
        if self.kind != "linear":
            values = [F.ln(v) for v in values]
        fitted = linear_expression(self.solution.coef, [F.lit(1.0), *values])
        return F.exp(fitted) if self.kind == "doublelog" else fitted

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        require_columns(df, self.features)
        return df.withColumn(name, self.expression())

    def predict_one(self, **x: float) -> float:
        missing = [f for f in self.features if f not in x]
        if missing:
            raise ValueError(f"columns not found: {missing}")
        values = np.array([x[f] for f in self.features], dtype=float)
        if self.kind != "linear":
            if (values <= 0).any():
                raise ValueError("values must be positive for a logarithm")
            values = np.log(values)
        fitted = float(self.solution.coef[0] + self.solution.coef[1:] @ values)
        return float(np.exp(fitted)) if self.kind == "doublelog" else fitted

    @property
    def r_squared(self) -> float:
        """In the scale the model is fitted in (log scale for double-log)."""
        s = self.solution
        return 0.0 if s.tss == 0 else 1.0 - s.rss / s.tss

    @property
    def adjusted_r_squared(self) -> float:
        s = self.solution
        return 1.0 - (1.0 - self.r_squared) * (s.n - 1) / s.dof if s.dof > 0 else float("nan")

    def coefficient_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, *r) for i, r in enumerate(term_rows(self.solution))]
        return spark.createDataFrame(rows, f"ord int, {TERM_SCHEMA}")

    def quality(self, spark: SparkSession) -> DataFrame:
        s = self.solution
        return spark.createDataFrame(
            [(self.kind, int(s.n), s.rank, self.r_squared, self.adjusted_r_squared, float(s.sigma2))],
            "model string, n_obs bigint, rank int, r_squared double, adjusted_r_squared double, sigma2 double")

    def summary(self) -> str:
        lines = [f"{self.kind} regression of {self.target}: n={int(self.solution.n)} "
                 f"R2={self.r_squared:.6f} adjusted={self.adjusted_r_squared:.6f}"]
        lines += [f"{t:>20} {c: .6g} (se {se:.6g}, t {st:.4g}, p {p:.4g})" for t, c, se, st, p in term_rows(self.solution)]
        return "\n".join(lines)

    # ---- effects

    def effect_expression(self, variable: str, x: Column) -> Column:
        """Marginal effect dy/dx at ``x``, the other features at their means."""
        beta = F.lit(self._slope(variable))
        if self.kind == "linear":
            return beta
        if self.kind == "semilog":
            return beta / x
        at = {f: F.lit(self.profile.mean[f]) for f in self.features} | {variable: x}
        return beta * self.expression(at) / x

    def marginal_effect(self, variable: str, x: float | None = None) -> float:
        x = self.profile.mean[self._known(variable)] if x is None else x
        beta = self._slope(variable)
        if self.kind == "linear":
            return beta
        if self.kind == "semilog":
            return beta / x
        return beta * self.predict_one(**(self.profile.mean | {variable: x})) / x

    def grid(self, spark: SparkSession, variable: str, n: int = 100) -> DataFrame:
        """(x, prediction, marginal_effect) over the training range of one variable."""
        low, high = self.profile.low[self._known(variable)], self.profile.high[variable]
        base = even_grid(spark.range(1), F.lit(low), F.lit(high), n).select("x")
        at = {f: F.lit(self.profile.mean[f]) for f in self.features} | {variable: F.col("x")}
        return base.select("x", self.expression(at).alias("prediction"),
                           self.effect_expression(variable, F.col("x")).alias("marginal_effect"))

    def saturation(self, spark: SparkSession, variable: str, n: int = 100) -> DataFrame:
        """Constant effect for linear models; otherwise the first grid x with |ME| <= 1% of its maximum."""
        return saturation_rows(self.grid(spark, variable, n), variable, self.kind, self._slope(variable))

    def _slope(self, variable: str) -> float:
        return self.slopes[self._known(variable)]


def saturation_rows(grid: DataFrame, variable: str, kind: str, slope: float | None) -> DataFrame:
    size = F.abs(F.col("marginal_effect"))
    top = grid.agg(F.max(size).alias("max_abs_marginal_effect"))
    reached = (F.lit(kind) != "linear") & (F.col("max_abs_marginal_effect") > 0)
    hit = reached & (size <= F.lit(0.01) * F.col("max_abs_marginal_effect"))
    turn = F.min(F.when(F.signum("marginal_effect") != F.signum("_first"), F.col("x")))
    first = grid.agg(F.min_by("marginal_effect", "x").alias("_first"))
    diminishing = F.lit(slope is not None and kind == "doublelog" and 0 < slope < 1)
    return grid.crossJoin(F.broadcast(top)).crossJoin(F.broadcast(first)).agg(
        F.lit(variable).alias("variable"), F.lit(kind).alias("model"),
        F.min("x").alias("x_min"), F.max("x").alias("x_max"),
        F.max("max_abs_marginal_effect").alias("max_abs_marginal_effect"),
        F.min(F.when(hit, F.col("x"))).alias("saturation_x"),
        turn.alias("sign_change_x"),
        F.first(diminishing).alias("diminishing_returns"),
    )


def fit_all(df: DataFrame, features: Sequence[str], target: str,
            kinds: Sequence[str] = KINDS) -> dict[str, Regression]:
    """Fit several kinds on the same rows from one aggregate over the data."""
    require_columns(df, [*features, target])
    unknown = [k for k in kinds if k not in KINDS]
    if unknown:
        raise ValueError(f"unknown model kind: {unknown}")
    raw = [*features, target]
    clean = complete_rows(df, raw).select(*[F.col(f"`{c}`").cast("double").alias(c) for c in raw])
    logs = [*(features if set(kinds) - {"linear"} else []), *([target] if "doublelog" in kinds else [])]
    rows = clean.withColumns({f"ln_{c}": F.ln(c) for c in logs}) if logs else clean
    spaces = {
        "linear": (list(features), target),
        "semilog": ([f"ln_{f}" for f in features], target),
        "doublelog": ([f"ln_{f}" for f in features], f"ln_{target}"),
    }
    if len(raw) > NATIVE_LIMIT:
        stats = {k: moments(rows, [*spaces[k][0], spaces[k][1]]) for k in kinds}
        edges = rows.agg(*_edges(raw)).collect()[0]
    else:
        aggs = [F.struct(*moment_columns([*spaces[k][0], spaces[k][1]])).alias(k) for k in kinds]
        edges = rows.agg(*_edges(raw), *aggs).collect()[0]
        stats = {k: moments_from_row(edges[k].asDict(), [*spaces[k][0], spaces[k][1]]) for k in kinds}
    bad = [c for c in logs if edges[f"lo_{c}"] is not None and edges[f"lo_{c}"] <= 0]
    if bad:
        raise ValueError(f"values must be positive for a logarithm: {bad}")
    if edges[f"lo_{raw[0]}"] is None:
        raise ValueError("no rows to fit")
    profile = Profile(*[{c: float(edges[f"{p}_{c}"]) for c in raw} for p in ("mean", "lo", "hi")])
    out = {}
    for k in kinds:
        x, y = spaces[k]
        s = solve(stats[k], x, y)
        named = Solution(("const", *features), s.coef, s.inverse, s.rank, s.n, s.rss, s.tss)
        out[k] = Regression(k, tuple(features), target, named, profile)
    return out


def _edges(columns: Sequence[str]) -> list[Column]:
    return [e for c in columns for e in (
        F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"), F.avg(c).alias(f"mean_{c}"))]


def compare_models(df: DataFrame, features: Sequence[str], target: str, with_spline: bool = False) -> DataFrame:
    """R2 in the scale of y for each model form, best first.

    The double-log R2 needs residuals after exp, so it is one more aggregate.
    """
    spark = df.sparkSession
    models = fit_all(df, features, target)
    double = models["doublelog"]
    err = F.col(f"`{target}`") - double.expression()
    s = complete_rows(df, [*features, target]).agg(
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.var_pop(target) * F.count(target))).alias("r2")).collect()[0]
    rows = [("linear", models["linear"].r_squared), ("semilog", models["semilog"].r_squared), ("doublelog", s["r2"])]
    if with_spline:
        rows.append(("spline", SplineModel.fit(df, features, target).r_squared))
    rows.sort(key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], "rank int, model string, r_squared double")


def robust_table(df: DataFrame, features: Sequence[str], target: str, order: str, by: Sequence[str] = (),
                 lags: int = 3, bucketed: bool = False) -> DataFrame:
    """OLS coefficients with Newey-West errors (Bartlett, normal tails, no small-sample factor)."""
    clean = complete_rows(df, [*features, target, order])
    s = solve(moments(clean, [*features, target]), features, target)
    x = [F.lit(1.0), *[F.col(f"`{f}`") for f in features]]
    residual = F.col(f"`{target}`") - linear_expression(s.coef, x)
    cov = newey_west(clean, x, residual, F.col(order), list(by), lags, s.inverse, bucketed)
    rows = [(i, *r) for i, r in enumerate(term_rows(s, cov, normal=True))]
    return df.sparkSession.createDataFrame(rows, f"ord int, {TERM_SCHEMA}")


# ---------------------------------------------------------------- additive splines


def spline_basis(x: np.ndarray, low: float, high: float, n: int) -> np.ndarray:
    """Uniform cubic B-splines on [low, high]; linear extension outside is not attempted (clamped)."""
    cells = n - 3
    u = (np.clip(x, low, high) - low) / ((high - low) or 1.0) * cells
    cell = np.minimum(u.astype(int), cells - 1)
    f = u - cell
    weights = np.stack([(1 - f) ** 3, 3 * f**3 - 6 * f**2 + 4, -3 * f**3 + 3 * f**2 + 3 * f + 1, f**3]) / 6.0
    out = np.zeros((len(x), n))
    rows = np.arange(len(x))
    for j in range(4):
        out[rows, cell + j] = weights[j]
    return out


@dataclass(frozen=True)
class SplineModel(EffectReports):
    """Sum of penalised cubic B-spline terms (second-difference penalty, Eilers and Marx 1996)."""

    features: tuple[str, ...]
    target: str
    n_splines: int
    lam: float
    profile: Profile
    coef: np.ndarray
    n: float
    rss: float
    tss: float
    edf: float

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str], target: str, lam: float = 0.6, n_splines: int = 20) -> SplineModel:
        if n_splines < 4:
            raise ValueError("at least 4 splines are needed")
        require_columns(df, [*features, target])
        columns = [*features, target]
        clean = complete_rows(df, columns)
        edges = clean.agg(*_edges(columns), F.stddev_pop(target).alias("sd")).collect()[0]
        if edges[f"lo_{target}"] is None:
            raise ValueError("no rows to fit")
        profile = Profile(*[{c: float(edges[f"{p}_{c}"]) for c in columns} for p in ("mean", "lo", "hi")])
        ranges = [(profile.low[f], profile.high[f]) for f in features]
        centre, scale = profile.mean[target], float(edges["sd"] or 1.0) or 1.0
        k = n_splines

        def expand(x):
            parts = [spline_basis(x[:, i], lo, hi, k) for i, (lo, hi) in enumerate(ranges)]
            return np.column_stack([*parts, (x[:, -1] - centre) / scale])

        size = k * len(ranges) + 2
        gram = collect_gram(wide_gram(clean, columns, expand), size)
        diff = np.diff(np.eye(k), n=2, axis=0)
        one = lam * diff.T @ diff + 1e-6 * np.eye(k)
        penalty = np.kron(np.eye(len(ranges)), one)
        coef, inverse, rss = ridge(gram, penalty)
        n = gram[0, 0]
        tss = float(gram[-1, -1] - gram[0, -1] ** 2 / n)
        edf = float(np.trace(inverse @ gram[:-1, :-1]))
        coef = coef * scale
        coef[0] += centre
        return cls(tuple(features), target, k, lam, profile, coef, float(n), rss * scale**2, tss * scale**2, edf)

    @property
    def r_squared(self) -> float:
        return 0.0 if self.tss == 0 else 1.0 - self.rss / self.tss

    def _blocks(self) -> dict[str, np.ndarray]:
        k = self.n_splines
        return {f: self.coef[1 + i * k: 1 + (i + 1) * k] for i, f in enumerate(self.features)}

    def _pieces(self, feature: str, x: Column) -> tuple[Column, Column, Column]:
        """Value and slope of one spline term inside its range, and how far ``x`` lies outside."""
        k, lo, hi = self.n_splines, self.profile.low[feature], self.profile.high[feature]
        cells = k - 3
        clipped = F.least(F.greatest(x.cast("double"), F.lit(lo)), F.lit(hi))
        u = (clipped - F.lit(lo)) / F.lit((hi - lo) or 1.0) * F.lit(float(cells))
        cell = F.least(F.floor(u).cast("int"), F.lit(cells - 1))
        f = u - cell
        table = F.array(*[F.lit(float(c)) for c in self._blocks()[feature]])
        weights = [
            (1 - f) * (1 - f) * (1 - f), 3 * f * f * f - 6 * f * f + 4, -3 * f * f * f + 3 * f * f + 3 * f + 1, f * f * f,
        ]
        slopes = [-3 * (1 - f) * (1 - f), 9 * f * f - 12 * f, -9 * f * f + 6 * f + 3, 3 * f * f]
        value, slope = (reduce(Column.__add__, [F.get(table, cell + j) * w / F.lit(6.0) for j, w in enumerate(ws)]) for ws in (weights, slopes))
        return value, slope * F.lit(cells / ((hi - lo) or 1.0)), x.cast("double") - clipped

    def term_expression(self, feature: str, x: Column) -> Column:
        """One spline term as a column expression: cell lookup and four weights, no Python.

        Outside the fitted range the term goes on in a straight line.
        """
        value, slope, outside = self._pieces(feature, x)
        return value + slope * outside

    def expression(self, at: dict[str, Column] | None = None) -> Column:
        source = {f: F.col(f"`{f}`") for f in self.features} | (at or {})
        total = F.lit(float(self.coef[0]))
        for f in self.features:
            total = total + self.term_expression(f, source[f])
        return total

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        require_columns(df, self.features)
        return df.withColumn(name, self.expression())

    def partial_dependence(self, spark: SparkSession, feature: str, n: int = 100) -> DataFrame:
        """The spline term of one feature evaluated on a grid over its range."""
        if feature not in self.features:
            raise ValueError(f"variable {feature!r} is not in the model")
        base = even_grid(spark.range(1), F.lit(self.profile.low[feature]), F.lit(self.profile.high[feature]), n)
        return base.select("x", self.term_expression(feature, F.col("x")).alias("partial"))

    def effect_expression(self, variable: str, x: Column) -> Column:
        """Derivative of the basis; other features do not matter in an additive model."""
        return self._pieces(self._known(variable), x)[1]

    def marginal_effect(self, variable: str, x: float | None = None) -> float:
        """Slope of one spline term at ``x``, by default at the variable's mean."""
        k, lo, hi = self.n_splines, self.profile.low[self._known(variable)], self.profile.high[variable]
        width = (hi - lo) or 1.0
        u = (min(max(self.profile.mean[variable] if x is None else float(x), lo), hi) - lo) / width * (k - 3)
        cell = min(int(u), k - 4)
        f = u - cell
        slopes = np.array([-3 * (1 - f) ** 2, 9 * f * f - 12 * f, -9 * f * f + 6 * f + 3, 3 * f * f])
        return float(self._blocks()[variable][cell:cell + 4] @ slopes) / 6.0 * (k - 3) / width

    def saturation(self, spark: SparkSession, variable: str, n: int = 100) -> DataFrame:
        base = even_grid(spark.range(1), F.lit(self.profile.low[variable]), F.lit(self.profile.high[variable]), n)
        grid = base.select("x", self.effect_expression(variable, F.col("x")).alias("marginal_effect"))
        return saturation_rows(grid, variable, "spline", None)

    def summary(self) -> str:
        return (f"spline regression of {self.target} on {', '.join(self.features)}: n={int(self.n)} "
                f"R2={self.r_squared:.6f} lam={self.lam} edf={self.edf:.2f}")


# ---------------------------------------------------------------- curve analysis


def turning_points(curve: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Where a response curve flattens: arg-min of the first and second derivative, and the
    first x past the 10% (first) and 5% (second) percentile."""
    from causeway.operators.windows import gradient

    d = gradient(gradient(curve, by, x, y, "_d1"), by, x, "_d1", "_d2")
    limits = d.groupBy(*by).agg(
        F.min_by(x, F.struct("_d1", x)).alias("x_min_slope"), F.min_by(x, F.struct("_d2", x)).alias("x_min_curvature"),
        F.percentile("_d1", F.lit(0.1)).alias("_p10"), F.percentile("_d2", F.lit(0.05)).alias("_p5"),
        F.sort_array(F.collect_list(F.struct(x, "_d1", "_d2"))).alias("_points"),
    )
    return limits.select(
        *by, "x_min_slope", "x_min_curvature",
        F.get(F.filter("_points", lambda p: p["_d1"] <= F.col("_p10")), F.lit(0))[x].alias("x_slope_p10"),
        F.get(F.filter("_points", lambda p: p["_d2"] > F.col("_p5")), F.lit(0))[x].alias("x_curvature_p5"),
    )


def stop_point(curve: DataFrame, by: Sequence[str], x: str, y: str, price: float, cost: float, margin: float) -> DataFrame:
    """First x where price * ME(x) - cost <= margin, with the effect and net value there."""
    from causeway.operators.windows import gradient, interpolate

    d = gradient(curve, by, x, y, "_me")
    net = F.lit(price) * F.col("_me") - F.lit(cost)
    stops = d.groupBy(*by).agg(F.min(F.when(net <= margin, F.col(x))).alias("x_stop"))
    named = stops.select(*[F.col(c).alias(f"_b_{c}") for c in by], "x_stop")
    match = F.lit(True)
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    joined = d.join(named, match) if by else d.crossJoin(F.broadcast(named))
    at_stop = interpolate(joined, by, x, "_me", F.col("x_stop"), "effect_at_stop")
    back = at_stop.join(stops, list(by)) if by else at_stop.crossJoin(stops)
    return back.select(
        *by, "x_stop", F.when(F.col("x_stop").isNotNull(), F.col("effect_at_stop")).alias("effect_at_stop"),
        F.when(F.col("x_stop").isNotNull(), F.lit(price) * F.col("effect_at_stop") - F.lit(cost)).alias("net_at_stop"),
    )
