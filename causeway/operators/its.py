"""Interrupted time series: segmented least squares with counterfactuals and checks.

Everything rests on segment moments: per (group, period) the count, means and co-moments
of ``t``, the rows since the period began ``w``, the covariates and the target. Inside one
period the dummies are constant, so these few numbers rebuild the moments of the whole
design whatever the number of interventions. One aggregate gives fit and effect table.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from causeway.functions.columns import OneHot, TooManyLevels, interval_dummy, period_index, period_label, string_columns
from causeway.functions.stats import normal_quantile, one_sample_t
from causeway.operators.gram import (
    TERM_SCHEMA, Moments, Solution, complete_rows, field_list, linear_expression, merge_moments,
    moments_by, moments_from_row, newey_west, solve, term_rows,
)
from causeway.operators.intervals import added, moments_of, window_moments
from causeway.operators.ordered import running_sum
from causeway.operators.sparse import SparseFit, fit_sparse
from causeway.operators.windows import elapsed, running_rows
from causeway.session import cut_lineage, require_columns

# fixed values: smallest sample of a check and the default (before, after) windows
MIN_ROWS = 10
DEFAULT_WINDOWS = ((12, 12), (18, 12), (12, 18), (24, 12), (12, 24))
EFFECT_COLUMNS = ["Actual_mean", "Predicted_mean", "Counterfactual_mean", "Effect_mean"]


def panel(facts: DataFrame, time: Column, target: Column, group: Column | None = None,
          covariates: dict[str, Column] | None = None) -> DataFrame:
    """Facts to one row per (group, time): a single combined aggregate before any window."""
    keys = ([group.alias("group")] if group is not None else []) + [time.alias("time")]
    return facts.groupBy(*keys).agg(
        target.alias("value"), *[c.alias(n) for n, c in (covariates or {}).items()]
    )


def validate(df: DataFrame, time: str, points: Sequence[float], group: str | None = None) -> None:
    require_columns(df, [time] + ([group] if group else []))
    span = df.agg(F.min(time).alias("lo"), F.max(time).alias("hi")).collect()[0]
    check_points(points, span["lo"], span["hi"])


def check_points(points: Sequence[float], low, high) -> None:
    if not points:
        raise ValueError("at least one intervention point is needed")
    for p in points:
        if low is None or not low <= p <= high:
            raise ValueError(f"intervention {p} lies outside the time range {low}..{high}")


def require_bucketed(df: DataFrame, keys: Sequence[str], time: str) -> None:
    """Raise unless there is one row per (group, time): lags and windows over buckets rest on it."""
    twice = df.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").limit(1).collect()
    if twice:
        where = ", ".join(f"{c}={twice[0][c]!r}" for c in (*keys, time))
        raise ValueError(f"{twice[0]['_n']} rows at {where}; bring facts to one row per (group, time) first, as panel does")


def timed(df: DataFrame, time: str, points: Sequence[float], group: str | Sequence[str] | None = None,
          bucketed: bool = False, from_one: bool = True) -> DataFrame:
    """Add ``t``, ``_period`` and ``w`` (rows since the period began, 0 before the first point).

    ``bucketed`` promises one row per (group, time), as ``panel`` gives; then one shuffle on the
    group serves both windows. Otherwise rows are counted per time first and rows that share a
    time share the count.
    """
    keys = [group] if isinstance(group, str) else list(group or [])
    out = df.withColumn("_period", period_index(F.col(time), points))
    if bucketed:
        by_group = Window.partitionBy(*(keys or [F.lit(0)]))
        in_period = Window.partitionBy(*(keys or [F.lit(0)]), "_period").orderBy(time)
        if from_one:
            out = out.withColumn("t", F.col(time) - F.min(time).over(by_group) + 1)
        out = out.withColumn("w", F.row_number().over(in_period).cast("bigint"))
    else:
        if from_one:
            out = elapsed(out, keys, time)
        out = running_rows(out, [*keys, "_period"], time, F.lit(1), "w")
    if not from_one:
        out = out.withColumn("t", F.col(time))
    return out.withColumn("w", F.when(F.col("_period") > 0, F.col("w")).otherwise(F.lit(0)).cast("bigint"))


def period_clock(df: DataFrame, time: str, keys: Sequence[str]) -> DataFrame:
    """Rows per (group, time): what a stored model needs to go on counting on new rows."""
    return df.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("_n"))


def carried_design(df: DataFrame, clock: DataFrame, time: str, points: Sequence[float], group: str | None,
                   intercept: bool = True, bucketed: bool = False) -> DataFrame:
    """``design`` of new rows whose ``timedelta_i`` go on from the rows of the fit.

    Times of the fit keep their count there, whichever of them the new rows hold; other times count
    the new rows up to them as well.
    """
    keys = [group] if group else []
    out = design(df, time, points, group, intercept, bucketed)

    def same(right: DataFrame) -> Column:
        return reduce(Column.__and__, [F.col(c).eqNullSafe(right[f"_c_{c}"]) for c in (*keys, time)])

    known = clock.select(*[F.col(c).alias(f"_c_{c}") for c in (*keys, time)], F.col("_n"))
    fresh = period_clock(df, time, keys)
    fresh = fresh.join(known.drop("_n"), same(known), "left_anti")
    cells = clock.select(*keys, time, "_n").unionByName(fresh).withColumn("_period", period_index(F.col(time), sorted(points)))
    if bucketed:
        upto = Window.partitionBy(*keys, "_period").orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
        cells = cells.withColumn("_w", F.sum("_n").over(upto))
    else:
        cells = running_sum(cells, [*keys, "_period"], [F.col(time)], F.col("_n"), "_w")
    cells = cells.select(*[F.col(c).alias(f"_c_{c}") for c in (*keys, time)], F.col("_period").alias("_c_period"), "_w")
    joined = out.join(cells, same(cells))
    terms = {f"timedelta_{i}": F.when(F.col("_c_period") == i, F.col("_w")).otherwise(F.lit(0)).cast("bigint")
             for i in range(1, len(points) + 1)}
    return joined.withColumns(terms).select(*out.columns)


def intervention_terms(n: int) -> list[str]:
    return [name for i in range(1, n + 1) for name in (f"D_{i}", f"timedelta_{i}")]


def design(df: DataFrame, time: str, points: Sequence[float], group: str | None = None,
           intercept: bool = True, bucketed: bool = False, from_one: bool = True) -> DataFrame:
    """Design columns t, D_i, timedelta_i and const next to the input columns."""
    ordered = sorted(points)
    out = timed(df, time, ordered, group, bucketed, from_one)
    columns = {}
    for i, start in enumerate(ordered, start=1):
        end = ordered[i] if i < len(ordered) else None
        columns[f"D_{i}"] = interval_dummy(F.col(time), start, end)
        columns[f"timedelta_{i}"] = F.when(F.col("_period") == i, F.col("w")).otherwise(F.lit(0)).cast("bigint")
    if intercept:
        columns["const"] = F.lit(1)
    return out.withColumns(columns).drop("_period", "w")


def assemble(parts: dict[int, Moments], n_points: int, covariates: Sequence[str], target: str) -> Moments:
    """Moments of the full design from per-period moments of (t, w, covariates, target)."""
    names = ("t", *intervention_terms(n_points), *covariates, target)
    full = []
    for period, m in parts.items():
        place = {"t": 0}
        if period > 0:
            place["w"] = 2 * period
        for c in (*covariates, target):
            place[c] = names.index(c)
        src = [m.index(n) for n in place]
        dst = list(place.values())
        mean = np.zeros(len(names))
        cov = np.zeros((len(names), len(names)))
        mean[dst] = m.mean[src]
        cov[np.ix_(dst, dst)] = m.cov[np.ix_(src, src)]
        if period > 0:
            mean[2 * period - 1] = 1.0
        full.append(Moments(names, m.n, mean, cov))
    return merge_moments(full)


def _segment_rows(pdf_or_rows, names) -> dict[int, Moments]:
    return {int(r["_period"]): moments_from_row(r, names) for r in pdf_or_rows}


def _period_means(m: Moments, coef: dict[str, float], period: int, covariates, target) -> tuple:
    """Actual, predicted, counterfactual and effect means: the model is linear, so means suffice."""
    base = coef.get("const", 0.0) + coef["t"] * m.average("t")
    base += sum(coef[c] * m.average(c) for c in covariates)
    predicted = base
    if period > 0:
        predicted += coef[f"D_{period}"] + coef[f"timedelta_{period}"] * m.average("w")
    actual = m.average(target)
    return actual, predicted, base, actual - base


def period_name(index: int) -> str:
    return "Pre-intervention" if index == 0 else f"Intervention_D_{index}"


def effects_per_group(df: DataFrame, time: str, points: Sequence[float], target: str, group: str,
                      covariates: Sequence[str] = (), bucketed: bool = False) -> DataFrame:
    """A separate fit for every group and its effect table, in one lazy plan.

    facts -> moments per (group, period) -> one solve per group over its few moment rows.
    """
    ordered = sorted(points)
    names = ["t", "w", *covariates, target]
    stats = moments_by(timed(df, time, ordered, group, bucketed), names, [group, "_period"])
    schema = T.StructType(field_list(df, [group]) + [
        T.StructField("Period", T.StringType()), T.StructField("n_obs", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in EFFECT_COLUMNS],
    ])
    covs = list(covariates)

    def fit_group(key, pdf):
        parts = _segment_rows(pdf.to_dict("records"), names)
        s = solve(assemble(parts, len(ordered), covs, target),
                  ["t", *intervention_terms(len(ordered)), *covs], target)
        coef = dict(zip(s.terms, s.coef, strict=True))
        rows = [
            (*key, period_name(i), int(m.n), *_period_means(m, coef, i, covs, target))
            for i, m in sorted(parts.items())
        ]
        return pd.DataFrame(rows, columns=[f.name for f in schema])

    return stats.groupBy(group).applyInPandas(fit_group, schema)


@dataclass(frozen=True)
class SegmentedFit:
    """Small result of a pooled segmented fit. Holds coefficients, never training rows."""

    time: str
    points: tuple[float, ...]
    group: str | None
    target: str
    covariates: tuple[str, ...]
    encoder: OneHot
    terms: tuple[str, ...]
    coef: tuple[float, ...]
    covariance: tuple[tuple[float, ...], ...]
    sigma2: float
    n_obs: int
    rank: int
    cov_type: str
    bucketed: bool
    rows: DataFrame | None = field(default=None, compare=False, repr=False)
    origins: DataFrame | None = field(default=None, compare=False, repr=False)
    clock: DataFrame | None = field(default=None, compare=False, repr=False)

    @property
    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.terms, self.coef, strict=True))

    def coefficient_table(self, spark: SparkSession) -> DataFrame:
        s = Solution(self.terms, np.array(self.coef), np.zeros((0, 0)), self.rank, self.n_obs, 0.0, 0.0)
        rows = term_rows(s, np.array(self.covariance), normal=self.cov_type == "HAC")
        return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"ord int, {TERM_SCHEMA}")

    def intervention_effects(self, spark: SparkSession) -> DataFrame:
        """Level (D_i) and trend (timedelta_i) change per intervention."""
        kind = F.when(F.col("term").startswith("D_"), "level").otherwise("trend")
        return self.coefficient_table(spark).filter(F.col("term").rlike("^(D|timedelta)_[0-9]+$")).select(
            F.regexp_extract("term", "([0-9]+)$", 1).cast("int").alias("intervention"),
            kind.alias("effect"), "term", "coef", "std_error", "statistic", "p_value",
        )

    # ---- rows

    def _design(self, df: DataFrame | None) -> DataFrame:
        if df is None:
            if self.rows is None:
                raise ValueError("this model was loaded from disk; pass the rows to predict")
            return self.rows
        require_columns(df, [self.time, *self.covariates] + ([self.group] if self.group else []))
        out = carried_design(df, self.clock, self.time, self.points, self.group, bucketed=self.bucketed)
        keys = [self.group] if self.group else []
        start = self.origins.select(*[F.col(k).alias(f"_g_{k}") for k in keys], F.col("origin").alias("_origin"))
        if keys:
            out = out.join(start, F.col(self.group).eqNullSafe(F.col(f"_g_{self.group}")), "left")
        else:
            out = out.crossJoin(F.broadcast(start))
        out = out.withColumn("t", F.coalesce(F.col(self.time) - F.col("_origin") + 1, F.col("t")))
        out = out.drop("_origin", *[f"_g_{k}" for k in keys])
        return self.encoder.transform(out)

    def _values(self, counterfactual: bool) -> list[Column]:
        zero = set(intervention_terms(len(self.points))) if counterfactual else set()
        return [F.lit(0.0) if t in zero else F.lit(1.0) if t == "const" else F.col(f"`{t}`") for t in self.terms]

    def mean(self, counterfactual: bool = False) -> Column:
        return linear_expression(self.coef, self._values(counterfactual))

    def _interval(self, counterfactual: bool, level: float) -> dict[str, Column]:
        x = self._values(counterfactual)
        quad = None
        for i in range(len(x)):
            for j in range(i, len(x)):
                v = float(self.covariance[i][j]) * (1.0 if i == j else 2.0)
                part = F.lit(v) * x[i].cast("double") * x[j].cast("double")
                quad = part if quad is None else quad + part
        z = normal_quantile(0.5 + level / 2.0)
        centre = self.mean(counterfactual)
        se = F.sqrt(F.greatest(quad, F.lit(0.0)))
        wide = F.sqrt(F.greatest(quad, F.lit(0.0)) + F.lit(self.sigma2))
        return {"mean_se": se, "mean_ci_lower": centre - z * se, "mean_ci_upper": centre + z * se,
                "obs_ci_lower": centre - z * wide, "obs_ci_upper": centre + z * wide}

    def predict(self, df: DataFrame | None = None, interval: bool = False, level: float = 0.95,
                counterfactual: bool = False) -> DataFrame:
        """Input rows plus ``mean`` (and interval columns); counterfactual drops the intervention terms."""
        rows = self._design(df)
        extra = {"mean": self.mean(counterfactual)}
        if interval:
            extra |= self._interval(counterfactual, level)
        return rows.withColumns(extra)

    def counterfactual(self, df: DataFrame | None = None, interval: bool = True) -> DataFrame:
        return self.predict(df, interval=interval, counterfactual=True)

    def plot_frame(self, df: DataFrame | None = None) -> DataFrame:
        """Actual, fitted and counterfactual mean with interval, phase and group, one row per point."""
        band = self._interval(True, 0.95)
        keys = [self.group] if self.group else []
        return self._design(df).select(
            *keys, F.col(self.time), period_label(F.col(self.time), self.points).alias("phase"),
            F.col(self.target).alias("actual"), self.mean().alias("fitted"),
            self.mean(True).alias("counterfactual"),
            band["mean_ci_lower"].alias("counterfactual_lower"), band["mean_ci_upper"].alias("counterfactual_upper"),
        )

    def effects(self, df: DataFrame | None = None) -> DataFrame:
        """Effect table per (group, Period): means of actual, predicted, counterfactual, difference."""
        keys = [self.group] if self.group else []
        return self._design(df).groupBy(
            *keys, period_label(F.col(self.time), self.points).alias("Period")
        ).agg(
            F.avg(self.target).alias("Actual_mean"), F.avg(self.mean()).alias("Predicted_mean"),
            F.avg(self.mean(True)).alias("Counterfactual_mean"),
            F.avg(F.col(self.target) - self.mean(True)).alias("Effect_mean"),
        )

    def release(self) -> None:
        """Drop the cached design rows."""
        if self.rows is not None:
            self.rows.unpersist()

    # ---- storage

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {k: getattr(self, k) for k in (
            "time", "points", "group", "target", "covariates", "terms", "coef", "covariance",
            "sigma2", "n_obs", "rank", "cov_type", "bucketed")}
        meta["levels"] = {c: list(v) for c, v in self.encoder.levels.items()}
        spark.createDataFrame([("ols", json.dumps(meta))], "kind string, meta string") \
            .write.mode("overwrite").parquet(f"{path}/meta")
        self.coefficient_table(spark).write.mode("overwrite").parquet(f"{path}/coefficients")
        self.origins.write.mode("overwrite").parquet(f"{path}/origins")
        self.clock.write.mode("overwrite").parquet(f"{path}/clock")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SegmentedFit:
        row = spark.read.parquet(f"{path}/meta").collect()[0]
        meta = json.loads(row["meta"])
        encoder = OneHot({c: tuple(v) for c, v in meta.pop("levels").items()})
        for name in ("points", "covariates", "terms", "coef"):
            meta[name] = tuple(meta[name])
        meta["covariance"] = tuple(tuple(r) for r in meta["covariance"])
        return cls(encoder=encoder, origins=spark.read.parquet(f"{path}/origins"), clock=spark.read.parquet(f"{path}/clock"), **meta)


@dataclass(frozen=True)
class SparseSegmentedFit:
    """Segmented fit whose covariate levels lie in a table: dense coefficients, in-sample means and effects."""

    time: str
    points: tuple[float, ...]
    group: str | None
    target: str
    fit: SparseFit
    cov_type: str
    rows: DataFrame = field(compare=False, repr=False)

    @property
    def coefficients(self) -> dict[str, float]:
        return self.fit.coefficients

    def coefficient_table(self, spark: SparkSession) -> DataFrame:
        return self.fit.coefficient_table(spark)

    def level_coefficients(self) -> DataFrame:
        """(covariate, level, coef) of all levels but the bases."""
        names = F.array(*[F.lit(c) for c in self.fit.categories])
        return self.fit.levels.select(F.get(names, F.col("column")).alias("covariate"), "level", "coef")

    def predict(self, counterfactual: bool = False) -> DataFrame:
        """Training rows plus ``mean``; the counterfactual drops the intervention terms."""
        return self.fit.mean(self.rows, intervention_terms(len(self.points)) if counterfactual else ())

    def effects(self) -> DataFrame:
        keys = [self.group] if self.group else []
        both = self.fit.mean(self.fit.mean(self.rows), intervention_terms(len(self.points)), "_without")
        return both.groupBy(*keys, period_label(F.col(self.time), self.points).alias("Period")).agg(
            F.avg(self.target).alias("Actual_mean"), F.avg("mean").alias("Predicted_mean"),
            F.avg("_without").alias("Counterfactual_mean"), F.avg(F.col(self.target) - F.col("_without")).alias("Effect_mean"))


class CandidateChecks:
    """Placebo tests and window sensitivity for any study model.

    A model provides ``_candidates(df, target, frame, covariates)``: every candidate row
    (candidate, lo, hi, point) is fitted on ``lo <= time < hi`` with one intervention at ``point``,
    all in the same job, giving (candidate, group, n_obs, effect).
    """

    time: str
    points: Sequence[float]
    group: str | None

    def _spans(self, df: DataFrame, target: str, bounds: Sequence[tuple[float, float]]) -> list:
        """Row count and time range for each half-open interval: one aggregate."""
        t = F.col(self.time)
        aggs = []
        for i, (lo, hi) in enumerate(bounds):
            inside = t < F.lit(hi)
            if not math.isinf(lo):
                inside = inside & (t >= F.lit(lo))
            aggs += [F.count(F.when(inside, t)).alias(f"n{i}"), F.min(F.when(inside, t)).alias(f"lo{i}"),
                     F.max(F.when(inside, t)).alias(f"hi{i}")]
        row = df.filter(t.isNotNull() & F.col(target).isNotNull()).agg(*aggs).collect()[0]
        return [(row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i in range(len(bounds))]

    def _frame(self, spark: SparkSession, rows: list[tuple]) -> DataFrame:
        return spark.createDataFrame(
            [(i, *[float(v) for v in r]) for i, r in enumerate(rows)],
            "candidate bigint, lo double, hi double, point double",
        )

    def placebo_effects(self, df: DataFrame, target: str, n_points: int = 3,
                        covariates: Sequence[str] = ()) -> DataFrame:
        """Effect at each fake intervention inside the pre-period: (placebo_point, placebo_effect)."""
        require_columns(df, [self.time, target, *covariates])
        first = min(self.points)
        (n, lo, hi), = self._spans(df, target, [(-math.inf, first)])
        if n < MIN_ROWS:
            raise ValueError(f"{n} rows before the first intervention, {MIN_ROWS} are needed")
        marks = [lo + (i + 1) * (hi - lo) / (n_points + 1) for i in range(n_points)]
        frame = self._frame(df.sparkSession, [(lo, first, p) for p in marks])
        effects = self._candidates(df, target, frame, covariates).groupBy("candidate").agg(
            F.avg("effect").alias("placebo_effect"))
        return effects.join(F.broadcast(frame), "candidate").select(
            F.col("point").alias("placebo_point"), "placebo_effect")

    def placebo_test(self, df: DataFrame, target: str, n_points: int = 3,
                     covariates: Sequence[str] = ()) -> DataFrame:
        """One row: mean, population std, t test against zero and validity of the placebo effects."""
        found = sorted(self.placebo_effects(df, target, n_points, covariates).collect())
        return df.sparkSession.createDataFrame(
            [summarise_placebo([r[1] for r in found]) + ([r[0] for r in found], [r[1] for r in found])],
            f"{PLACEBO_SCHEMA}, placebo_points array<double>, placebo_effects array<double>")

    def placebo_per_intervention(self, df: DataFrame, target: str, n_points: int = 3,
                                 covariates: Sequence[str] = ()) -> DataFrame:
        """Placebo effects for each real intervention, using rows since the previous one.

        Intervals with fewer than ten rows or a zero time span are left out.
        """
        require_columns(df, [self.time, target, *covariates])
        bounds = [(-math.inf if i == 0 else self.points[i - 1], p) for i, p in enumerate(self.points)]
        rows, labels = [], []
        for i, (n, lo, hi) in enumerate(self._spans(df, target, bounds)):
            if n < MIN_ROWS or hi == lo:
                continue
            for j in range(n_points):
                mark = lo + (j + 1) * (hi - lo) / (n_points + 1)
                labels.append((len(rows), i, float(self.points[i]), float(mark)))
                rows.append((lo, self.points[i], mark))
        spark = df.sparkSession
        named = spark.createDataFrame(
            labels, "candidate bigint, real_intervention_index int, real_intervention_point double, placebo_point double")
        effects = self._candidates(df, target, self._frame(spark, rows), covariates).groupBy("candidate").agg(
            F.avg("effect").alias("placebo_effect"), F.stddev_samp("effect").alias("placebo_effect_std"))
        return named.join(effects, "candidate").drop("candidate")

    def window_sensitivity(self, df: DataFrame, target: str,
                           windows: Sequence[tuple[int, int]] = DEFAULT_WINDOWS,
                           covariates: Sequence[str] = ()) -> DataFrame:
        """Effect per (intervention, pre, post) window, both ends inclusive; under ten rows is left out."""
        require_columns(df, [self.time, target, *covariates])
        spark = df.sparkSession
        plan = [(p, a, b) for a, b in windows for p in self.points]
        named = spark.createDataFrame(
            [(i, float(p), int(a), int(b)) for i, (p, a, b) in enumerate(plan)],
            "candidate bigint, intervention_point double, pre_window int, post_window int")
        after = [float(np.nextafter(p + b, math.inf)) for p, _, b in plan]
        frame = self._frame(spark, [(p - a, hi, p) for (p, a, _), hi in zip(plan, after, strict=True)])
        effects = self._candidates(df, target, frame, covariates).filter(F.col("n_obs") >= MIN_ROWS).groupBy(
            "candidate").agg(F.avg("effect").alias("effect_mean"), F.stddev_samp("effect").alias("effect_std"))
        return named.join(effects, "candidate").drop("candidate")


@dataclass(frozen=True)
class SegmentedOls(CandidateChecks):
    """Pooled segmented regression: ``SegmentedOls("time", [27, 54], "group").fit(df, "value")``."""

    time: str
    points: Sequence[float]
    group: str | None = None
    bucketed: bool = False

    def __post_init__(self):
        object.__setattr__(self, "points", tuple(sorted(self.points)))

    def fit(self, df: DataFrame, target: str, covariates: Sequence[str] = (), cov_type: str = "HAC",
            hac_lags: int = 3, intercept: bool = True, cache: bool = True) -> SegmentedFit | SparseSegmentedFit:
        """Pooled fit. Text covariates become dummies; where one has very many levels the fit is a ``fit_sparse``."""
        if cov_type not in ("HAC", "nonrobust"):
            raise ValueError(f"unknown cov_type {cov_type!r}")
        require_columns(df, [self.time, target, *covariates] + ([self.group] if self.group else []))
        texts = set(string_columns(df))
        try:
            encoder = OneHot.fit(df, [c for c in covariates if c in texts])
        except TooManyLevels:
            return self.fit_sparse(df, target, covariates, cov_type, hac_lags, intercept)
        numeric = [c for c in covariates if c not in texts]
        cov_terms = [n for c in covariates for n in (
            [f"{c}_{v}" for v in encoder.levels[c][1:]] if c in texts else [c])]
        keys = [self.group] if self.group else []
        clean = complete_rows(df, [self.time, target, *keys, *covariates])
        rows = encoder.transform(timed(clean, self.time, self.points, self.group, self.bucketed))
        terms = intervention_terms(len(self.points))
        rows = rows.withColumns({
            **{f"D_{i}": (F.col("_period") == i).cast("int") for i in range(1, len(self.points) + 1)},
            **{f"timedelta_{i}": F.when(F.col("_period") == i, F.col("w")).otherwise(F.lit(0))
               for i in range(1, len(self.points) + 1)},
        })
        if cache:
            rows = rows.persist()
        names = ["t", "w", *cov_terms, target]
        ends = [F.min(self.time).alias("lo"), F.max(self.time).alias("hi")]
        found = moments_by(rows, names, ["_period"], ends).collect()  # one row per period
        try:
            check_points(self.points, min((r["lo"] for r in found), default=None), max((r["hi"] for r in found), default=None))
        except ValueError:
            rows.unpersist()
            raise
        parts = _segment_rows(found, names)
        full = assemble(parts, len(self.points), cov_terms, target)
        s = solve(full, ["t", *terms, *cov_terms], target, intercept)
        cov = s.covariance
        if cov_type == "HAC":
            x = [F.lit(1.0) if t == "const" else F.col(f"`{t}`") for t in s.terms]
            residual = F.col(target) - linear_expression(s.coef, x)
            cov = newey_west(rows, x, residual, F.col(self.time), keys, hac_lags, s.inverse, self.bucketed)
        origins = clean.groupBy(*keys).agg(F.min(self.time).alias("origin"))
        return SegmentedFit(
            self.time, tuple(self.points), self.group, target, tuple(covariates), encoder, s.terms,
            tuple(map(float, s.coef)), tuple(tuple(map(float, r)) for r in cov), float(s.sigma2), int(s.n),
            s.rank, cov_type, self.bucketed, rows.drop("_period", "w"), origins, period_clock(clean, self.time, keys),
        )

    def fit_sparse(self, df: DataFrame, target: str, covariates: Sequence[str] = (), cov_type: str = "HAC",
                   hac_lags: int = 3, intercept: bool = True) -> SparseSegmentedFit:
        """The same fit with the levels of text covariates in a table, for any number of them."""
        if cov_type not in ("HAC", "nonrobust"):
            raise ValueError(f"unknown cov_type {cov_type!r}")
        keys = [self.group] if self.group else []
        require_columns(df, [self.time, target, *covariates, *keys])
        texts = set(string_columns(df))
        categories, numeric = ([c for c in covariates if (c in texts) == want] for want in (True, False))
        clean = complete_rows(df, [self.time, target, *keys, *covariates])
        span = clean.agg(F.min(self.time).alias("lo"), F.max(self.time).alias("hi")).collect()[0]
        check_points(self.points, span["lo"], span["hi"])
        rows = timed(clean, self.time, self.points, self.group, self.bucketed)
        rows = rows.withColumns({
            **{f"D_{i}": (F.col("_period") == i).cast("int") for i in range(1, len(self.points) + 1)},
            **{f"timedelta_{i}": F.when(F.col("_period") == i, F.col("w")).otherwise(F.lit(0)) for i in range(1, len(self.points) + 1)},
            **({"const": F.lit(1.0)} if intercept else {})}).drop("_period", "w")
        rows = cut_lineage(rows)
        dense = [*(["const"] if intercept else []), "t", *intervention_terms(len(self.points)), *numeric]
        fit = fit_sparse(rows, dense, categories, target)
        if cov_type == "HAC":
            moved, names = fit.influence(fit.mean(rows, name="_mean"))
            hac = newey_west(moved, [F.col(c) for c in names], F.col(target) - F.col("_mean"), F.col(self.time), keys, hac_lags,
                             np.eye(len(dense)), self.bucketed)
            fit = replace(fit, covariance=hac)
        return SparseSegmentedFit(self.time, tuple(self.points), self.group, target, fit, cov_type, rows)

    # ---- refits from one read of the rows

    def _candidates(self, df: DataFrame, target: str, frame: DataFrame, covariates: Sequence[str]) -> DataFrame:
        """(candidate, group, n_obs, effect) where each candidate row is (candidate, lo, hi, point).

        Rows are reduced to moments per (group, elementary interval) once; a candidate is fitted from the
        intervals of its window, pooled over groups.
        """
        keys = [self.group] if self.group else []
        windows = [(r["lo"], r["hi"], r["point"]) for r in sorted(frame.collect())]  # parameter-sized
        values = [*covariates, target]
        names = ["t", "w", *values]
        size = 1 + len(names) + len(names) * (len(names) + 1) // 2
        cells = cut_lineage(window_moments(df, self.time, values, windows, keys))
        sums = added(cells, ["pre", "post"], size, ["candidate", "at"])
        covs = list(covariates)

        def fit_rows(batches):
            for pdf in batches:
                out = []
                for r in pdf.itertuples(index=False):
                    parts = {i: m for i, m in enumerate(moments_of(x, names, r.at) for x in (r.pre, r.post)) if m.n}
                    s = solve(assemble(parts, 1, covs, target), ["t", "D_1", "timedelta_1", *covs], target)
                    out.append((r.candidate, s.coef.tolist(), int(s.n)))
                yield pd.DataFrame(out, columns=["fitted", "coef", "n_obs"])

        fits = sums.mapInPandas(fit_rows, "fitted bigint, coef array<double>, n_obs bigint")
        group = [F.col(c) for c in keys] or [F.lit(0).alias("_all")]
        n = F.col("post")[0]
        post = cells.filter(n > 0).select(
            "candidate", *group, (F.col("post")[1] / n).alias("_t"),
            *[(F.col("post")[3 + i] / n + F.col("at")[i]).alias(f"_v{i}") for i in range(len(values))])
        joined = post.join(fits, F.col("candidate") == F.col("fitted"))
        baseline = F.col("coef")[0] + F.col("coef")[1] * F.col("_t")
        for i in range(len(covs)):
            baseline = baseline + F.col("coef")[4 + i] * F.col(f"_v{i}")
        return joined.select("candidate", *(keys or ["_all"]), "n_obs", (F.col(f"_v{len(covs)}") - baseline).alias("effect"))


PLACEBO_SCHEMA = (
    "mean_placebo_effect double, std_placebo_effect double, t_statistic double, p_value double, "
    "is_valid boolean, n_placebo_tests bigint"
)


def summarise_placebo(effects: Sequence[float]) -> tuple:
    n = len(effects)
    if n == 0:
        return (None, None, None, None, None, 0)
    t, p = one_sample_t(effects)
    known = not math.isnan(p)
    return (float(np.mean(effects)), float(np.std(effects)), t if known else None, p if known else None,
            bool(p > 0.05) if known else None, n)


def candidate_rows(df: DataFrame, frame: DataFrame, time: str) -> DataFrame:
    """Buckets of each candidate window with time measured from the candidate point.

    The candidate list is a parameter-sized frame, broadcast. After the shift every candidate has
    its intervention at zero.
    """
    shifted = (F.col(time) - F.col("point")).cast("double")
    return df.join(F.broadcast(frame), (F.col(time) >= F.col("lo")) & (F.col(time) < F.col("hi"))).withColumn(
        time, shifted).drop("lo", "hi", "point")


def compare_effects(tables: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Effect_mean of several models side by side, matched on group and period."""
    out = None
    for name, table in tables.items():
        one = table.select(*keys, F.col("Effect_mean").alias(f"effect_{name}"))
        out = one if out is None else out.join(one, list(keys))
    return out


