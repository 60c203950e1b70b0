"""Uncertainty of a trend ahead: future changes of slope drawn by hashes.

Changes come as often as in the past and are as large on average (Laplace). A row per (future time, replicate) holds
its draws, running sums per replicate add them up, and quantiles per time are one aggregate, so replicates are
rows and the same seed gives the same draws whatever the partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def uniform(seed: int, stream: int, *keys: Column) -> Column:
    """A number in (0, 1) from a hash of the keys."""
    h = F.xxhash64(F.lit(seed), F.lit(stream), *keys)
    return (F.pmod(h, F.lit(1 << 52)).cast("double") + 0.5) / F.lit(float(1 << 52))


def laplace(u: Column, size: Column | float) -> Column:
    """Laplace draw with mean absolute value ``size``."""
    side = u - 0.5
    return -size * F.signum(side) * F.log1p(-2 * F.abs(side))


def normal(u: Column, v: Column) -> Column:
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * v)


def trend_draws(times: DataFrame, start: float, rate: float, size: float, noise: float, replicates: int = 1000,
                seed: int = 42) -> DataFrame:
    """(_day, replicate, trend, draw) for the distinct future ``_day`` of ``times``: deviation of the trend, and with noise.

    ``rate`` is the expected number of slope changes a day and ``size`` their mean absolute value a day. In
    a step of length h a change comes with probability 1 - exp(-rate h), anywhere in the step.
    """
    steps = times.filter(F.col("_day") > start).select("_day").distinct()  # the calendar ahead
    before = F.coalesce(F.lag("_day").over(Window.orderBy("_day")), F.lit(float(start)))
    rows = steps.withColumn("_h", F.col("_day") - before).crossJoin(
        F.broadcast(times.sparkSession.range(replicates).select(F.col("id").alias("replicate"))))
    key = (F.col("replicate"), F.col("_day"))
    comes = uniform(seed, 1, *key) < 1 - F.exp(-rate * F.col("_h"))
    rows = rows.withColumn("_change", F.when(comes, laplace(uniform(seed, 2, *key), size)).otherwise(0.0))
    each = Window.partitionBy("replicate").orderBy("_day")  # one replicate's steps
    slope = F.coalesce(F.sum("_change").over(each.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rows = rows.withColumn("_moved", slope * F.col("_h") + F.col("_change") * F.col("_h") * uniform(seed, 3, *key))
    rows = rows.withColumn("trend", F.sum("_moved").over(each.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.select("_day", "replicate", "trend", (F.col("trend") + noise * normal(uniform(seed, 4, *key), uniform(seed, 5, *key))).alias("draw"))


def trend_interval(times: DataFrame, start: float, rate: float, size: float, noise: float, level: float = 0.95,
                   replicates: int = 1000, seed: int = 42) -> DataFrame:
    """(_day, _below, _above): quantiles of the draws around the mean, a row per future day."""
    tail = (1 - level) / 2
    return trend_draws(times, start, rate, size, noise, replicates, seed).groupBy("_day").agg(
        F.percentile("draw", F.lit(tail)).alias("_below"), F.percentile("draw", F.lit(1 - tail)).alias("_above"))


def with_trend_interval(mean: DataFrame, start: float, rate: float, size: float, noise: float, level: float = 0.95,
                        replicates: int = 1000, seed: int = 42) -> DataFrame:
    """``mean`` (mean, lower, upper, _day, ...) with the interval of rows after ``start`` from draws of the trend."""
    ahead = trend_interval(mean, start, rate, size, noise, level, replicates, seed)
    joined = mean.join(F.broadcast(ahead), "_day", "left")  # a row per future day
    return joined.withColumns({"lower": F.coalesce(F.col("mean") + F.col("_below"), F.col("lower")),
                               "upper": F.coalesce(F.col("mean") + F.col("_above"), F.col("upper"))}).select(*mean.columns)
