"""Window operators over bucketed series: one row per (group, time bucket).

A window here holds the buckets of one series, whose number is set by the calendar and
not by the facts. For windows over raw rows see ``ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causeway.operators.ordered import affine_scan, nearest_known, ordered_scan
from causeway.session import require_columns


def elapsed(df: DataFrame, group: Sequence[str], time: str, name: str = "t") -> DataFrame:
    """``time - min(time) + 1`` per group. The minimum is a combined aggregate joined back,
    so a hot group is never gathered in one task."""
    start = df.groupBy(*group).agg(F.min(time).alias("_start"))
    if not group:
        joined = df.crossJoin(F.broadcast(start))
    else:
        start = start.select(*[F.col(c).alias(f"_g_{c}") for c in group], "_start")
        match = None
        for c in group:
            one = F.col(c).eqNullSafe(F.col(f"_g_{c}"))
            match = one if match is None else match & one
        joined = df.join(start, match)
    return joined.select(*df.columns, (F.col(time) - F.col("_start") + 1).alias(name))


def running_rows(df: DataFrame, group: Sequence[str], time: str, flag: Column, name: str,
                 calendar: bool = False) -> DataFrame:
    """Running number of flagged rows per group, for any number of rows per time.

    Rows are first counted per (group, time) with map-side combine. Rows sharing a time share the
    count, so row order never matters. ``calendar`` promises a coarse time (months, days): one
    window per group then holds the distinct times. Otherwise an ordered scan spreads them.
    """
    cells = df.groupBy(*group, time).agg(F.sum(flag.cast("bigint")).alias("_n"))
    if calendar:
        upto = Window.partitionBy(*(group or [F.lit(0)])).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
        counted = cells.withColumn(name, F.sum("_n").over(upto))
    else:
        counted = ordered_scan(cells, group, [F.col(time)], {name: F.col("_n")}, position=None)
    counts = counted.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col(time).alias("_time"), name)
    match = F.col(time).eqNullSafe(F.col("_time"))
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return df.join(counts, match).select(*df.columns, name)


def gradient(df: DataFrame, by: Sequence[str], x: str, y: str, name: str) -> DataFrame:
    """First derivative on a grid: second order inside for uneven steps, one-sided at the ends."""
    w = Window.partitionBy(*by).orderBy(x)
    back_x, ahead_x = F.lag(x).over(w), F.lead(x).over(w)
    back_y, ahead_y = F.lag(y).over(w), F.lead(y).over(w)
    hs, hd = F.col(x) - back_x, ahead_x - F.col(x)
    inner = (hs * hs * ahead_y + (hd * hd - hs * hs) * F.col(y) - hd * hd * back_y) / (hs * hd * (hs + hd))
    edge = F.coalesce((ahead_y - F.col(y)) / hd, (F.col(y) - back_y) / hs)
    return df.withColumn(name, F.coalesce(inner, edge))


def interpolate(df: DataFrame, by: Sequence[str], x: str, y: str, at: Column, name: str) -> DataFrame:
    """Value of the curve at a point by linear interpolation, clamped outside the range."""
    below = F.max(F.when(F.col(x) <= at, F.struct(F.col(x).alias("x"), F.col(y).alias("y"))))
    above = F.min(F.when(F.col(x) >= at, F.struct(F.col(x).alias("x"), F.col(y).alias("y"))))
    ends = df.groupBy(*by).agg(below.alias("_lo"), above.alias("_hi"), F.max(at).alias("_q"))
    share = F.try_divide(F.col("_q") - F.col("_lo.x"), F.col("_hi.x") - F.col("_lo.x"))
    inside = F.col("_lo.y") + F.coalesce(share, F.lit(0.0)) * (F.col("_hi.y") - F.col("_lo.y"))
    return ends.select(*by, F.coalesce(inside, F.col("_lo.y"), F.col("_hi.y")).alias(name))


def interpolate_points(curve: DataFrame, points: DataFrame, by: Sequence[str], x: str, y: str, name: str) -> DataFrame:
    """``points`` (by..., x, ...) with ``name``: the value of their group's curve (by..., x, y), linear between its
    rows and clamped outside its range.

    Points and curve rows are merged in one order and each point looks at the curve rows next to it, so nothing is
    joined and a long curve or very many points are spread over tasks. Several curve rows at one x
    count with their mean; rows without x or y are no part of it. Points without a curve or x get null.
    """
    require_columns(curve, [*by, x, y])
    require_columns(points, [*by, x])
    own = curve.select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).dropna(subset=["_x", "_y"])
    own = own.groupBy(*by, "_x").agg(F.avg("_y").alias("_y"))
    asked = points.select(*by, F.col(x).cast("double").alias("_x"), F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_point"))
    both = asked.withColumn("_y", F.lit(None).cast("double")).unionByName(own, allowMissingColumns=True)
    # of rows at one x the curve's comes first, and the points' own order doesn't matter
    found = nearest_known(both, list(by), [F.col("_x"), F.col("_y").isNull(), F.xxhash64("_point"), F.monotonically_increasing_id()], "_x", "_y")
    low, high = F.col("_before"), F.col("_after")
    share = (F.col("_x") - low["at"]) / (high["at"] - low["at"])
    inside = F.when(low["at"] == F.col("_x"), low["value"]).when(high["at"] == low["at"], low["value"]).otherwise(
        low["value"] + share * (high["value"] - low["value"]))
    value = F.when(F.col("_x").isNotNull() & ~F.isnan("_x"), F.coalesce(inside, low["value"], high["value"]))
    return found.filter(F.col("_point").isNotNull()).select("_point.*", value.alias(name))


def adstock(df: DataFrame, by: Sequence[str], time: str, x: str, decay: float | Column, name: str) -> DataFrame:
    """Carry-over ``s = decay * s_before + x`` over the buckets of a series; all earlier buckets count."""
    share = decay if isinstance(decay, Column) else F.lit(float(decay))
    return affine_scan(df, by, [F.col(time)], {name: (share, F.col(x))})


def lags(df: DataFrame, by: Sequence[str], time: str, column: str, steps: Sequence[int]) -> DataFrame:
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(time)
    return df.withColumns({f"{column}_lag{j}": F.lag(column, j).over(w) for j in steps})


def difference(
    df: DataFrame, by: Sequence[str], time: str, columns: Sequence[str], d: int = 0, seasonal_d: int = 0, period: int = 0
) -> DataFrame:
    """Ordinary (d times) and seasonal (seasonal_d times, lag ``period``) differences in place."""
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(time)
    for step in [1] * d + [period] * (seasonal_d if period else 0):
        df = df.withColumns({c: F.col(c) - F.lag(c, step).over(w) for c in columns})
    return df


def seasonal_profile(df: DataFrame, date: str, value: str, feature: str) -> DataFrame:
    """Mean per (calendar feature, year) minus that year's mean; ``feature`` is month or week."""
    part = {"month": F.month(date), "week": F.weekofyear(date)}[feature]
    year = F.year(date) if feature == "month" else F.extract(F.lit("YEAROFWEEK"), F.col(date))
    cells = df.groupBy(part.alias(feature), year.alias("year")).agg(
        F.sum(value).alias("_s"), F.count(value).alias("_n")
    )
    mean = F.col("_s") / F.col("_n")
    centre = F.avg(mean).over(Window.partitionBy("year"))
    return cells.select(feature, "year", mean.alias("mean_value"), (mean - centre).alias("centred"))
