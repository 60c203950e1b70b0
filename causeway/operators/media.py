"""Media mix: carry-over and saturation fit, contributions, response curves, budget split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causeway.functions.columns import even_grid
from causeway.operators.choice import allocate
from causeway.operators.gram import collect_gram, pack_by, ridge, unpack_gram, wide_gram
from causeway.operators.ordered import affine_scan, ordered_scan
from causeway.session import require_columns

# candidate grid
DECAYS = (0.0, 0.3, 0.6)
HALVES = (0.5, 1.0, 2.0)
SLOPES = (0.7, 1.0)


def saturate(x: Column, half: Column, slope: Column) -> Column:
    powered = F.pow(x, slope)
    return F.when(x <= 0, F.lit(0.0)).otherwise(powered / (powered + F.pow(half, slope)))


def channel_effects(media: DataFrame, params: DataFrame) -> DataFrame:
    """(date, channel, x, spend, stock, effect) for given (channel, decay, half, slope, beta).

    ``params`` has one row per channel and joins on it. The carry-over reaches back to a channel's first
    date; a channel's dates may be spread over many tasks.
    """
    require_columns(media, ["date", "channel", "x", "spend"])
    require_columns(params, ["channel", "decay", "half", "slope", "beta"])
    rows = affine_scan(media.join(params, "channel"), ["channel"], [F.col("date")], {"stock": (F.col("decay"), F.col("x"))})
    effect = F.col("beta") * saturate(F.col("stock"), F.col("half"), F.col("slope"))
    return rows.select("date", "channel", "x", "spend", "stock", effect.alias("effect"))


def contribution(effects: DataFrame, sales: DataFrame) -> DataFrame:
    """Share of sales and return per unit of spend by channel."""
    total = sales.agg(F.sum("sales").alias("_total"))
    sums = effects.groupBy("channel").agg(F.sum("effect").alias("contribution"), F.sum("spend").alias("spend"))
    return sums.crossJoin(F.broadcast(total)).select(
        "channel", "contribution", "spend", F.try_divide("contribution", "_total").alias("share"),
        F.try_divide("contribution", "spend").alias("roi"))


def response_curves(params: DataFrame, ranges: DataFrame, n: int = 50) -> DataFrame:
    """(channel, x, response) on an even grid from zero to the largest stock of each channel."""
    base = even_grid(params.join(ranges, "channel"), F.lit(0.0), F.col("high"), n)
    response = F.col("beta") * saturate(F.col("x"), F.col("half"), F.col("slope"))
    return base.select("channel", "x", response.alias("response"))


def baseline_split(effects: DataFrame, sales: DataFrame) -> DataFrame:
    """Per date: sales, media part and the remaining baseline."""
    media = effects.groupBy("date").agg(F.sum("effect").alias("media"))
    return sales.join(media, "date", "left").select(
        "date", "sales", F.coalesce("media", F.lit(0.0)).alias("media"),
        (F.col("sales") - F.coalesce("media", F.lit(0.0))).alias("baseline"))


def _envelope(x: Column, half: Column, slope: Column) -> Column:
    """Concave envelope of the saturation curve: a chord up to the tangent point when slope > 1."""
    touch = half * F.pow(F.greatest(slope - 1.0, F.lit(0.0)), 1.0 / slope)
    chord = saturate(touch, half, slope) / touch * x
    return F.when((slope > 1.0) & (x < touch), chord).otherwise(saturate(x, half, slope))


def budget_split(params: DataFrame, budget: float, steps: int = 100) -> DataFrame:
    """Spend per channel that maximises predicted response under a budget.

    ``params`` adds ``price`` (cost per media unit). The budget is cut into equal steps; each
    channel offers its step gains on the concave envelope, and the best ``steps`` of all are taken.
    Exact on that grid for slope <= 1.
    """
    require_columns(params, ["channel", "half", "slope", "beta", "price"])
    size = budget / steps
    offers = params.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    at = F.col("step") * F.lit(size) / F.col("price")
    before = (F.col("step") - 1) * F.lit(size) / F.col("price")
    gain = F.col("beta") * (_envelope(at, F.col("half"), F.col("slope")) - _envelope(before, F.col("half"), F.col("slope")))
    offers = offers.select("channel", "step", "price", "half", "slope", "beta", gain.alias("gain"))
    ranked = ordered_scan(offers, [], [F.desc("gain"), F.asc("channel"), F.asc("step")], position="place")
    taken = ranked.filter((F.col("place") <= steps) & (F.col("gain") > 0)).groupBy("channel").agg(
        (F.count(F.lit(1)) * F.lit(size)).alias("spend"))
    response = F.col("beta") * saturate(F.col("spend") / F.col("price"), F.col("half"), F.col("slope"))
    return params.join(taken, "channel", "left").fillna(0.0, ["spend"]).select(
        "channel", "spend", response.alias("response"))


def exact_budget_split(params: DataFrame, budget: float, steps: int = 100) -> DataFrame:
    """``budget_split`` by (max, +) convolution: the best split into whole steps for curves of any shape."""
    require_columns(params, ["channel", "half", "slope", "beta", "price"])
    size = budget / steps
    x = F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda i: i * F.lit(size) / F.col("price"))
    values = F.transform(x, lambda v: F.col("beta") * saturate(v, F.col("half"), F.col("slope")))
    found = allocate(params.select(F.col("channel").alias("item"), values.alias("values")), [], steps)
    spent = found.select(F.col("item").alias("channel"), (F.col("weight") * F.lit(size)).alias("spend"))
    response = F.col("beta") * saturate(F.col("spend") / F.col("price"), F.col("half"), F.col("slope"))
    return params.join(spent, "channel").select("channel", "spend", response.alias("response"))


# ---------------------------------------------------------------- fit


@dataclass(frozen=True)
class MediaFit:
    """Shape (decay, half-point, slope) and effect of each channel, trained in units of the means.

    ``coef`` holds the constant, the channels' effects and the calendar terms. ``gram`` are the
    cross-products [1, saturated channels, calendar, sales] of the training rows at these shapes.
    """

    channels: tuple[str, ...]
    shapes: tuple[tuple[float, float, float], ...]
    scale: dict[str, float]
    sales_scale: float
    coef: np.ndarray
    rss: float
    orders: int
    gram: np.ndarray

    def _common(self, i: int) -> float:
        values = {shape[i] for shape in self.shapes}
        if len(values) > 1:
            raise ValueError("channels have shapes of their own; see shapes")
        return values.pop()

    @property
    def decay(self) -> float:
        return self._common(0)

    @property
    def half(self) -> float:
        return self._common(1)

    @property
    def slope(self) -> float:
        return self._common(2)

    def params(self, spark) -> DataFrame:
        rows = [(c, d, h * self.scale[c], s, float(self.coef[1 + i]) * self.sales_scale)
                for i, (c, (d, h, s)) in enumerate(zip(self.channels, self.shapes, strict=True))]
        return spark.createDataFrame(rows, "channel string, decay double, half double, slope double, beta double")

    def design_rows(self, media: DataFrame) -> DataFrame:
        """(date, s0_0, s1_0, ..., dow, doy): the channels' scaled carry-over at their own decay."""
        own = F.create_map(*[F.lit(v) for c, (d, _, _) in zip(self.channels, self.shapes, strict=True) for v in (c, d)])
        return _carried(media, self.channels, self.scale, [own[F.col("channel")]])

    def columns(self) -> list[str]:
        return [*[f"s{i}_0" for i in range(len(self.channels))], "dow", "doy"]

    def expand(self, x: np.ndarray) -> np.ndarray:
        m = len(self.channels)
        shaped = [_saturated(x[:, i], h, s) for i, (_, h, s) in enumerate(self.shapes)]
        return np.column_stack([*shaped, _season(x[:, m], x[:, m + 1], self.orders)])

    def predict(self, media: DataFrame) -> DataFrame:
        """(date, predicted) in units of sales for every date of ``media``.

        Give the training dates too when later ones are wanted: the carry-over goes on from them. Dates of
        before and after are scaled by the training means, and the result is scaled back.
        """
        coef, expand, unit = self.coef, self.expand, self.sales_scale

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            return pd.Series((coef[0] + expand(x) @ coef[1:]) * unit)

        return self.design_rows(media).select("date", score(*self.columns()).alias("predicted"))


def _season(day_of_week: np.ndarray, day_of_year: np.ndarray, orders: int) -> np.ndarray:
    parts = [(day_of_week == d).astype(float) for d in range(1, 7)]
    for k in range(1, orders + 1):
        angle = 2 * np.pi * k * day_of_year / 365.0
        parts += [np.sin(angle), np.cos(angle)]
    return np.column_stack(parts)


def _saturated(x: np.ndarray, half: float, slope: float) -> np.ndarray:
    powered = np.power(np.maximum(x, 0.0), slope)
    return np.where(x > 0, powered / (powered + half**slope), 0.0)


def _carried(media: DataFrame, channels: Sequence[str], scale: dict[str, float], decays: Sequence[Column]) -> DataFrame:
    """One row per date: carry-over ``s{channel}_{decay}`` of each channel in units of its mean, and the calendar."""
    means = F.create_map(*[F.lit(v) for c in channels for v in (c, float(scale[c]))])
    own = media.filter(F.col("channel").isin(*channels)).select("date", "channel", (F.col("x") / means[F.col("channel")]).alias("x"))
    states = affine_scan(own, ["channel"], [F.col("date")], {f"_s{j}": (d, F.col("x")) for j, d in enumerate(decays)})
    return states.groupBy("date").agg(*[
        F.coalesce(F.sum(F.when(F.col("channel") == c, F.col(f"_s{j}"))), F.lit(0.0)).alias(f"s{i}_{j}")
        for i, c in enumerate(channels) for j in range(len(decays))]).withColumns({
            "dow": F.weekday("date").cast("double"), "doy": F.dayofyear("date").cast("double")})


def _with_sales(rows: DataFrame, sales: DataFrame, sales_scale: float) -> DataFrame:
    return rows.join(sales.select("date", (F.col("sales") / F.lit(sales_scale)).alias("y")), "date")


def _media_solve(gram: np.ndarray, n_media: int, strength: float) -> tuple[np.ndarray, float]:
    """Ridge with non-negative media effects: a negative effect is set to zero and the rest refitted."""
    k = gram.shape[0] - 2
    live = list(range(k))
    while True:
        index = [0, *[1 + i for i in live], gram.shape[0] - 1]
        coef, _, rss = ridge(gram[np.ix_(index, index)], np.full(len(live), strength))
        bad = [i for i, c in zip(live, coef[1:], strict=True) if i < n_media and c < 0]
        if not bad:
            full = np.zeros(k + 1)
            full[0] = coef[0]
            full[[1 + i for i in live]] = coef[1:]
            return full, rss
        live = [i for i in live if i not in bad]


def _search_shapes(score, n_channels: int, n_shapes: int, start: int) -> list[int]:
    """Coordinate search: each channel in turn takes its best shape given the others', until none changes."""
    chosen = [start] * n_channels
    best = score(chosen)
    changed = True
    while changed:
        changed = False
        for i in range(n_channels):
            for g in range(n_shapes):
                tried = [*chosen[:i], g, *chosen[i + 1:]]
                rss = score(tried)
                if rss < best * (1 - 1e-12):
                    best, chosen, changed = rss, tried, True
    return chosen


def fit_media(media: DataFrame, sales: DataFrame, channels: Sequence[str] | None = None, decays=DECAYS, halves=HALVES,
              slopes=SLOPES, orders: int = 1, strength: float = 0.1, own_shapes: bool = False) -> tuple[MediaFit, DataFrame]:
    """Fit (decay, half-point, slope) and effects from one pooled cross-product.

    The rows are read for the means and once more for the cross-products of all (channel, decay,
    half-point, slope) columns; every candidate is then a sub-matrix. One shape for all channels is the best
    of the grid; with ``own_shapes`` each channel then searches its own from there. Returns the fit and the
    score table of the common shapes. Media and sales are scaled by their means. Without ``channels`` all
    channels of the table are taken, in order of name; their number sets the size of the cross-products.
    """
    require_columns(media, ["date", "channel", "x"])
    require_columns(sales, ["date", "sales"])
    spark = media.sparkSession
    picked = media if channels is None else media.filter(F.col("channel").isin(*channels))
    found = {r["channel"]: r["m"] for r in picked.groupBy("channel").agg(F.avg("x").alias("m")).collect()}
    channels = tuple(sorted(c for c in found if c is not None)) if channels is None else tuple(channels)
    missing = [c for c in channels if not found.get(c)]
    if missing or not channels:
        raise ValueError(f"channels without data: {missing}")
    mean_sales = sales.agg(F.avg("sales").alias("m")).collect()[0]["m"]
    if not mean_sales:
        raise ValueError("sales are zero or missing")
    scale, m = {c: float(found[c]) for c in channels}, len(channels)
    rows = _with_sales(_carried(media, channels, scale, [F.lit(float(d)) for d in decays]), sales, mean_sales)
    shapes = [(float(d), float(h), float(s)) for d, h, s in product(decays, halves, slopes)]
    pairs = list(product(halves, slopes))
    states = m * len(decays)

    def expand(x):
        shaped = [_saturated(x[:, i], h, s) for i in range(states) for h, s in pairs]
        return np.column_stack([*shaped, _season(x[:, states], x[:, states + 1], orders), x[:, -1]])

    columns = [*[f"s{i}_{j}" for i in range(m) for j in range(len(decays))], "dow", "doy", "y"]
    rest = 6 + 2 * orders + 1
    gram = collect_gram(wide_gram(rows, columns, expand), 1 + m * len(shapes) + rest)

    def part(chosen: Sequence[int]) -> np.ndarray:
        index = [0, *[1 + i * len(shapes) + g for i, g in enumerate(chosen)], *range(len(gram) - rest, len(gram))]
        return gram[np.ix_(index, index)]

    def score(chosen: Sequence[int]) -> float:
        return _media_solve(part(chosen), m, strength)[1]

    scores = [(g, score([g] * m), *shape) for g, shape in enumerate(shapes)]
    best = min(scores, key=lambda r: (r[1], r[0]))[0]
    chosen = _search_shapes(score, m, len(shapes), best) if own_shapes else [best] * m
    coef, rss = _media_solve(part(chosen), m, strength)
    fit = MediaFit(channels, tuple(shapes[g] for g in chosen), scale, float(mean_sales), coef, float(rss), orders, part(chosen))
    return fit, spark.createDataFrame(scores, "candidate int, rss double, decay double, half double, slope double")


def _poisson_weight(u: Column) -> Column:
    """Poisson(1) draw from a uniform value of 30 bits by its cumulative distribution."""
    steps, cumulative, p, k = [], 0.0, float(np.exp(-1.0)), 0
    while cumulative < 1.0 - 2.0**-31:  # beyond this no uniform value lies
        cumulative += p
        steps.append((k, cumulative))
        k += 1
        p /= k
    out = F.lit(k)
    for value, limit in reversed(steps):
        out = F.when(u < limit, F.lit(value)).otherwise(out)
    return out.cast("double")


def bootstrap_effects(media: DataFrame, sales: DataFrame, fit: MediaFit, replicates: int = 200, block_days: int = 7,
                      strength: float = 0.1, seed: int = 42) -> DataFrame:
    """Block bootstrap of channel effects: (channel, mean, lower, median, upper) in raw units.

    Cross-products are summed per time block once; a replicate only reweights the block sums, so
    rows are never copied. Weights are Poisson(1) from a hash of (block, replicate).
    """
    spark = media.sparkSession
    m = len(fit.channels)
    rows = _with_sales(fit.design_rows(media), sales, fit.sales_scale)
    blocks = rows.withColumn("block", F.floor(F.date_diff("date", F.lit("1970-01-01").cast("date")) / block_days).cast("bigint"))
    shaped = fit.expand

    def expand(x):
        return np.column_stack([shaped(x[:, :-1]), x[:, -1]])

    sums = wide_gram(blocks, [*fit.columns(), "y"], expand, ["block"])
    reps = spark.range(replicates).select(F.col("id").cast("int").alias("replicate"))
    uniform = F.pmod(F.xxhash64("block", "replicate", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    weighted = sums.crossJoin(F.broadcast(reps)).groupBy("replicate", "pos").agg(
        F.sum(F.col("value") * _poisson_weight(uniform)).alias("value"))
    size = len(fit.gram)
    names, scale = list(fit.channels), fit.sales_scale

    def solve_rows(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                gram = unpack_gram(np.asarray(r.entries), size)
                if gram[0, 0] <= 0:
                    continue
                coef, _ = _media_solve(gram, m, strength)
                out += [(r.replicate, c, float(coef[1 + i]) * scale) for i, c in enumerate(names)]
            yield pd.DataFrame(out, columns=["replicate", "channel", "beta"])

    draws = pack_by(weighted, ["replicate"]).mapInPandas(solve_rows, "replicate int, channel string, beta double")
    return _summary(draws)


def _summary(draws: DataFrame) -> DataFrame:
    return draws.groupBy("channel").agg(
        F.count(F.lit(1)).alias("n_replicates"), F.avg("beta").alias("mean"),
        F.percentile("beta", F.lit(0.025)).alias("lower"), F.percentile("beta", F.lit(0.5)).alias("median"),
        F.percentile("beta", F.lit(0.975)).alias("upper"))


# ---------------------------------------------------------------- posterior


def _half_normal_tail(rng: np.random.Generator, mean: float, sd: float) -> float:
    """A normal draw that is not negative."""
    low = -mean / sd
    if low < 0.5:
        while True:
            z = rng.standard_normal()
            if z >= low:
                return mean + sd * z
    rate = (low + np.sqrt(low * low + 4)) / 2  # exponential proposals far in the tail
    while True:
        z = low + rng.exponential(1 / rate)
        if rng.random() <= np.exp(-((z - rate) ** 2) / 2):
            return mean + sd * z


def _gibbs(gram: np.ndarray, m: int, draws: int, warmup: int, rng: np.random.Generator) -> np.ndarray:
    """Draws (effects..., residual sd) of y = constant + calendar + media effects >= 0 + noise.

    Constant and calendar have flat priors and are integrated out by the Schur complement, effects are
    flat on the non-negative half line, the residual variance has the prior 1/variance.
    """
    media, others, y = slice(1, 1 + m), [0, *range(1 + m, len(gram) - 1)], len(gram) - 1
    keep = [*range(1, 1 + m), y]
    away = np.linalg.pinv(gram[np.ix_(others, others)], rcond=1e-12, hermitian=True)
    left = gram[np.ix_(keep, keep)] - gram[np.ix_(keep, others)] @ away @ gram[np.ix_(others, keep)]
    xx, xy, yy = left[:-1, :-1], left[:-1, -1], left[-1, -1]
    dof = gram[0, 0] - np.linalg.matrix_rank(gram[np.ix_(others, others)], tol=1e-9 * gram[0, 0], hermitian=True)
    if dof <= 0:
        raise ValueError("fewer rows than calendar terms")
    beta = np.abs(rng.standard_normal(m)) * 0.1
    out = np.empty((draws, m + 1))
    floor = 1e-12 * max(yy, 1e-300)
    for n in range(-warmup, draws):
        rss = max(yy - 2 * beta @ xy + beta @ xx @ beta, floor)
        variance = rss / (2 * rng.standard_gamma(dof / 2))
        for j in range(m):
            if xx[j, j] > 1e-12 * gram[media, media][j, j]:
                mean = beta[j] + (xy[j] - xx[j] @ beta) / xx[j, j]
                beta[j] = _half_normal_tail(rng, mean, np.sqrt(variance / xx[j, j]))
        if n >= 0:
            out[n, :m], out[n, m] = beta, np.sqrt(variance)
    return out


def posterior_draws(spark, fit: MediaFit, chains: int = 4, draws: int = 1000, warmup: int = 500, seed: int = 42) -> DataFrame:
    """(chain, draw, channel, beta) in raw units: Gibbs chains on the fit's cross-products, one chain a task.

    A chain depends on the seed and its number only.
    """
    gram, names, unit, m = fit.gram, list(fit.channels), fit.sales_scale, len(fit.channels)

    def run(frames):
        for pdf in frames:
            for chain in pdf["id"].tolist():
                found = _gibbs(gram, m, draws, warmup, np.random.default_rng([seed, chain]))[:, :m] * unit
                yield pd.DataFrame({"chain": chain, "draw": np.repeat(np.arange(draws), m), "channel": names * draws, "beta": found.ravel()})

    return spark.range(0, chains, 1, chains).mapInPandas(run, "chain bigint, draw bigint, channel string, beta double")


def posterior_effects(draws: DataFrame) -> DataFrame:
    """(channel, n_replicates, mean, lower, median, upper, split_rhat): posterior summary and convergence.

    ``split_rhat`` compares the halves of all chains: near 1 when they agree.
    """
    top = draws.agg(((F.max("draw") + 1) / 2).alias("_half"))  # one row
    parts = draws.crossJoin(F.broadcast(top)).groupBy("channel", "chain", (F.col("draw") < F.col("_half")).alias("early")).agg(
        F.avg("beta").alias("mean"), F.var_samp("beta").alias("var"), F.count(F.lit(1)).alias("n"))
    spread = parts.groupBy("channel").agg(F.var_samp("mean").alias("between"), F.avg("var").alias("within"), F.avg("n").alias("n"))
    rhat = spread.select("channel", F.sqrt((F.col("n") - 1) / F.col("n") + F.try_divide("between", "within")).alias("split_rhat"))
    return _summary(draws).join(rhat, "channel")
