"""Forecasts of one bucketed series: calendar ridge, changepoint selection, expanding validation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causeway.operators.gram import collect_gram, unpack_gram
from causeway.operators.trend import with_trend_interval
from causeway.operators.widefit import WideDesign, WideFit, fit_wide, solve_wide
from causeway.session import keep, require_columns

YEAR = 365.25
STEPS = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH"}


def regular_series(df: DataFrame, time: str, value: str, freq: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per period between the first and last of each series; gaps get a null value."""
    if freq not in STEPS:
        raise ValueError(f"freq must be one of {sorted(STEPS)}")
    require_columns(df, [time, value, *by])
    start = F.date_trunc(freq, F.col(time)).cast("date")
    cells = df.groupBy(*by, start.alias("_at")).agg(F.sum(value).alias("value"))
    spans = cells.groupBy(*by).agg(F.min("_at").alias("_lo"), F.max("_at").alias("_hi"))
    calendar = spans.select(*by, F.explode(F.sequence("_lo", "_hi", F.expr(STEPS[freq]))).alias("_at"))
    return calendar.join(cells, [*by, "_at"], "left").select(*by, F.col("_at").alias("time"), "value")


def day_number(date: Column) -> Column:
    return F.date_diff(date, F.lit("1970-01-01").cast("date")).cast("double")


def _calendar(days: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Month (0-11) and position in the year [0, 1)."""
    dates = np.floor(days).astype("int64").astype("datetime64[D]")
    months = dates.astype("datetime64[M]").astype("int64") % 12
    years = dates.astype("datetime64[Y]")
    first = years.astype("datetime64[D]").astype("int64")
    length = (years + 1).astype("datetime64[D]").astype("int64") - first
    return months, (days - first) / length


def _waves(position: np.ndarray, order: int) -> np.ndarray:
    angles = 2 * np.pi * np.outer(position, np.arange(1, order + 1))
    return np.hstack([np.sin(angles), np.cos(angles)])


def calendar_design(origin: float, order: int, knots: Sequence[float]) -> WideDesign:
    """Trend, square root of trend, trend by month, yearly Fourier pairs and changepoint hinges."""
    marks = np.asarray(knots, dtype=float)

    def expand(x):
        days = x[:, 0]
        months, position = _calendar(days)
        ct = (days - origin) / YEAR
        by_month = np.zeros((len(ct), 12))
        by_month[np.arange(len(ct)), months] = ct
        hinges = np.maximum(ct[:, None] - (marks[None, :] - origin) / YEAR, 0.0)
        return np.column_stack([ct, np.sqrt(np.maximum(ct, 0.0)), by_month, _waves(position, order), hinges])

    blocks = (("trend", 2), ("month_trend", 12), ("seasonality", 2 * order), ("changepoints", len(marks)))
    return WideDesign(("_day",), expand, blocks)


@dataclass(frozen=True)
class SeriesFacts:
    n: int
    first: float
    last: float
    mean: float
    std: float


def series_facts(series: DataFrame) -> SeriesFacts:
    require_columns(series, ["time", "value"])
    rows = series.filter(F.col("value").isNotNull() & F.col("time").isNotNull())
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.min(day_number(F.col("time"))).alias("lo"),
                 F.max(day_number(F.col("time"))).alias("hi"), F.avg("value").alias("m"),
                 F.stddev_pop("value").alias("s")).collect()[0]
    if not r["n"]:
        raise ValueError("no rows to fit")
    return SeriesFacts(r["n"], r["lo"], r["hi"], float(r["m"]), float(r["s"] or 1.0) or 1.0)


def _dated(series: DataFrame) -> DataFrame:
    return series.withColumn("_day", day_number(F.col("time")))


def candidate_knots(facts: SeriesFacts, every_days: float = 14.0, quiet_days: float = 60.0) -> list[float]:
    """Possible changepoints every ``every_days``, none in the last ``quiet_days``."""
    return [float(k) for k in np.arange(facts.first + every_days, facts.last - quiet_days + 1e-9, every_days)]


def _lasso(a: np.ndarray, b: np.ndarray, lam: float, rounds: int = 500) -> np.ndarray:
    """Coordinate descent for 0.5 w'Aw - b'w + lam |w|, on a k x k matrix."""
    w = np.zeros(len(b))
    diag = np.diag(a)
    live = diag > 1e-12
    for _ in range(rounds):
        worst = 0.0
        for j in np.flatnonzero(live):
            free = b[j] - a[j] @ w + diag[j] * w[j]
            new = np.sign(free) * max(abs(free) - lam, 0.0) / diag[j]
            worst = max(worst, abs(new - w[j]))
            w[j] = new
        if worst < 1e-10:
            break
    return w


def select_changepoints(series: DataFrame, strength: float = 0.5, every_days: float = 14.0,
                        quiet_days: float = 60.0, order: int = 25) -> list[float]:
    """Changepoints kept by a lasso on hinge terms, trend and seasonality left unpenalised.

    ``strength`` is the penalty as a share of the smallest one that removes every hinge. The lasso
    runs on the k x k cross-products only. Neighbouring hinges of the same sign count as one.
    """
    series = keep(series)
    facts = series_facts(series)
    knots = candidate_knots(facts, every_days, quiet_days)
    if not knots:
        return []
    marks = np.asarray(knots)

    def expand(x):
        days = x[:, 0]
        _, position = _calendar(days)
        ct = (days - facts.first) / YEAR
        hinges = np.maximum(ct[:, None] - (marks[None, :] - facts.first) / YEAR, 0.0)
        return np.column_stack([ct, _waves(position, order), hinges])

    design = WideDesign(("_day",), expand, (("free", 1 + 2 * order), ("hinges", len(marks))))
    gram = collect_gram(design.gram(_dated(series), "value", facts.mean, facts.std), design.size + 2)
    u = slice(0, 2 + 2 * order)
    h = slice(2 + 2 * order, 2 + 2 * order + len(marks))
    uu = np.linalg.pinv(gram[u, u], rcond=1e-12, hermitian=True)
    a = gram[h, h] - gram[h, u] @ uu @ gram[u, h]
    b = gram[h, -1] - gram[h, u] @ uu @ gram[u, -1]
    size = np.sqrt(np.maximum(np.diag(a), 0.0))
    unit = np.where(size > 1e-9, size, 1.0)
    a, b = a / np.outer(unit, unit), np.where(size > 1e-9, b / unit, 0.0)
    w = _lasso(a, b, strength * float(np.abs(b).max(initial=0.0)))
    chosen: list[int] = []
    for j in np.flatnonzero(np.abs(w) > 1e-8):
        if chosen and j - chosen[-1] == 1 and np.sign(w[j]) == np.sign(w[chosen[-1]]):
            if abs(w[j]) > abs(w[chosen[-1]]):
                chosen[-1] = int(j)
        else:
            chosen.append(int(j))
    return [knots[j] for j in chosen]


@dataclass(frozen=True)
class CalendarForecast:
    """Ridge forecast of a (time, value) series on calendar terms."""

    order: int = 25
    strength: float = 0.1
    knots: tuple[float, ...] | None = None
    changepoint_strength: float = 0.5

    def design(self, facts: SeriesFacts, knots: Sequence[float]) -> WideDesign:
        return calendar_design(facts.first, self.order, knots)

    def penalty(self, design: WideDesign) -> np.ndarray:
        p = np.full(design.size, self.strength)
        p[design.block_slices()["trend"].start] = self.strength * 1e-3
        return p

    def with_knots(self, series: DataFrame) -> CalendarForecast:
        if self.knots is not None:
            return self
        return replace(self, knots=tuple(select_changepoints(series, self.changepoint_strength)))

    def fit(self, series: DataFrame) -> WideFit:
        ours = not series.is_cached
        series = keep(series)
        try:
            model = self.with_knots(series)
            facts = series_facts(series)
            design = model.design(facts, model.knots)
            return fit_wide(_dated(series), design, "value", model.penalty(design), facts.mean, facts.std)
        finally:
            if ours:
                series.unpersist()


def fitted_rows(fit: WideFit, series: DataFrame, components: bool = False) -> DataFrame:
    return fit.predict(_dated(series), components=components).drop("_day")


def forecast(fit: WideFit, series: DataFrame, steps: int, freq: str = "week", level: float = 0.95) -> DataFrame:
    """The next ``steps`` periods after the end of the series with an interval."""
    unit = F.expr(STEPS[freq])
    last = series.agg(F.max("time").cast("date").alias("_last"))
    ahead = last.select(F.explode(F.sequence(F.col("_last") + unit, F.col("_last") + unit * steps, unit)).alias("time"))
    return fit.predict(_dated(ahead), level=level).drop("_day")


def forecast_with_trend(fit: WideFit, series: DataFrame, steps: int, freq: str = "week", level: float = 0.95,
                        replicates: int = 1000, seed: int = 42) -> DataFrame:
    """``forecast`` whose interval widens by future slope changes, drawn like the selected changepoints.

    A model without changepoints has none ahead either.
    """
    facts = series_facts(series)
    part = fit.design.block_slices()["changepoints"]
    knots, span = part.stop - part.start, facts.last - facts.first
    rows = _dated(forecast(fit, series, steps, freq, level))
    if not knots or not span:
        return rows.drop("_day")
    size = float(np.abs(fit.coef[part.start + 1:part.stop + 1]).mean()) * fit.scale / YEAR
    noise = float(np.sqrt(fit.sigma2)) * fit.scale
    return with_trend_interval(rows, facts.last, knots / span, size, noise, level, replicates, seed).drop("_day")


# ---------------------------------------------------------------- expanding-window validation


def cv_splits(series: DataFrame, horizon: int = 4, min_train: int = 104, max_splits: int = 6) -> DataFrame:
    """(split, train_end, test_start, test_end, n_train): most recent splits first, windows do not overlap.

    Works on distinct periods, so the ranking holds one row per period.
    """
    require_columns(series, ["time"])
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("time"))
    periods = series.select("time").distinct().withColumn("_pos", place)
    total = periods.agg(F.max("_pos").alias("_n"))
    split = F.ceil((F.col("_n") - F.col("_pos") + 1) / F.lit(horizon)).cast("int")
    tests = periods.crossJoin(F.broadcast(total)).withColumn("split", split).filter(
        (F.col("split") <= max_splits) & (F.col("_n") - F.col("split") * horizon >= min_train))
    windows = tests.groupBy("split").agg(
        F.min("time").alias("test_start"), F.max("time").alias("test_end"),
        (F.min("_pos") - 1).cast("bigint").alias("n_train"))
    ends = periods.select(F.col("time").alias("train_end"), F.col("_pos").cast("bigint").alias("_p"))
    return windows.join(ends, F.col("n_train") == F.col("_p")).select(
        "split", "train_end", "test_start", "test_end", "n_train")


def cross_validate(model: CalendarForecast, series: DataFrame, horizon: int = 4, min_train: int = 104,
                   max_splits: int = 6, strengths: Sequence[float] | None = None) -> DataFrame:
    """Test and train error per (strength, split).

    Cross-products are summed once per block between split points; the training set of a split is
    a sum of blocks, so rows are read once for all splits and strengths. Centre and scale of the target only
    keep the sums small: the constant isn't penalised, so predictions don't depend on them.
    """
    spark = series.sparkSession
    series = keep(series)
    strengths = [float(s) for s in (strengths or [model.strength])]
    splits = sorted(cv_splits(series, horizon, min_train, max_splits).collect(), key=lambda r: r["train_end"])
    if not splits:
        raise ValueError(f"the series is too short for {min_train} training periods")
    facts = series_facts(series)
    ends = [_epoch_day(r["train_end"]) for r in splits]
    first_train = series.filter(day_number(F.col("time")) <= ends[0])
    ready = model.with_knots(first_train)  # changepoints from the shortest training set only
    design = ready.design(facts, ready.knots)
    rows = _dated(series).withColumn("_block", F.size(F.filter(
        F.array(*[F.lit(float(e)) for e in ends]), lambda e: e < F.col("_day"))))
    grams = {b: np.zeros((design.size + 2, design.size + 2)) for b in range(len(ends) + 1)}
    parts: dict[int, dict[int, float]] = {}
    for r in design.gram(rows, "value", facts.mean, facts.std, ["_block"]).collect():
        parts.setdefault(r["_block"], {})[r["pos"]] = r["value"]
    for b, cells in parts.items():
        grams[b] = unpack_gram(np.array([cells[i] for i in range(len(cells))]), design.size + 2)
    fits = {}
    for i in range(len(ends)):
        train = sum(grams[b] for b in range(i + 1))
        for s in strengths:
            fits[(i, s)] = solve_wide(train, replace(ready, strength=s).penalty(design))[0]
    expand, centre, scale = design.expand, facts.mean, facts.std
    tests = [(_epoch_day(r["test_start"]), _epoch_day(r["test_end"])) for r in splits]

    def score(batches):
        for pdf in batches:
            days, y = pdf["_day"].to_numpy(), pdf["value"].to_numpy()
            z = np.column_stack([np.ones(len(days)), expand(days[:, None])])
            out = []
            for (i, s), coef in fits.items():
                err = y - (z @ coef * scale + centre)
                for part, mask in (("train", days <= ends[i]), ("test", (days >= tests[i][0]) & (days <= tests[i][1]))):
                    ok = mask & (y != 0)
                    out.append((i, s, part, int(mask.sum()), float((err[mask] ** 2).sum()), float(np.abs(err[mask]).sum()),
                                float(np.abs(err[ok] / y[ok]).sum()), int(ok.sum())))
            yield pd.DataFrame(out, columns=["i", "strength", "part", "n", "sq", "ab", "ape", "n_ape"])

    scored = rows.filter(F.col("value").isNotNull()).select("_day", F.col("value").cast("double").alias("value")).mapInPandas(
        score, "i int, strength double, part string, n bigint, sq double, ab double, ape double, n_ape bigint")
    named = spark.createDataFrame([(i, r["split"]) for i, r in enumerate(splits)], "i int, split int")
    sums = scored.groupBy("i", "strength", "part").agg(*[F.sum(c).alias(c) for c in ("n", "sq", "ab", "ape", "n_ape")])
    return sums.join(F.broadcast(named), "i").select(
        "split", "strength", "part", "n", F.sqrt(F.try_divide("sq", "n")).alias("rmse"),
        F.try_divide("ab", "n").alias("mae"), (F.try_divide("ape", "n_ape") * 100).alias("mape"))


def rank_candidates(scores: DataFrame) -> DataFrame:
    """(strength, mean_test_mape, mean_train_mape, rank), best first; the frame is grid-sized."""
    means = scores.groupBy("strength").agg(
        F.avg(F.when(F.col("part") == "test", F.col("mape"))).alias("mean_test_mape"),
        F.avg(F.when(F.col("part") == "train", F.col("mape"))).alias("mean_train_mape"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("mean_test_mape", "strength"))
    return means.withColumn("rank", place)


def _epoch_day(date) -> float:
    return float((np.datetime64(date, "D") - np.datetime64("1970-01-01", "D")).astype(int))
