"""Filters, splits, aggregates, pivots, resampling and top-k over tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causeway.operators.ordered import ordered_scan
from causeway.operators.ranks import order_statistics
from causeway.session import require_columns


def hash_split(df: DataFrame, key: Column, percent_test: int = 25, seed: int = 20) -> DataFrame:
    """Repeatable split flag ``is_test``: a hash of a row key, whatever the partitioning or the engine.

    The first 32 bits of the md5 of ``key:seed`` as text; a null key counts as an empty text.
    """
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}"))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("is_test", F.pmod(number, F.lit(100)) < percent_test)


def last_periods_split(df: DataFrame, period: str, n_test: int) -> DataFrame:
    """Flag rows of the last ``n_test`` distinct periods.

    The cut is the smallest of the top-n distinct periods, a one-row frame.
    """
    require_columns(df, [period])
    cut = (
        df.select(period).distinct().orderBy(F.desc(period)).limit(n_test)
        .agg(F.min(period).alias("_cut"))
    )
    return df.crossJoin(F.broadcast(cut)).withColumn("is_test", F.col(period) >= F.col("_cut")).drop("_cut")


def pivot_sum(df: DataFrame, index: str, column: str, value: str, levels: Sequence[str] | None = None) -> DataFrame:
    """Long to wide with zero fill. Levels that are given need no extra pass; without them one combined
    aggregate finds all that the table has, one result column each."""
    if levels is None:
        levels = sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)
    return df.groupBy(index).pivot(column, list(levels)).agg(F.sum(value)).fillna(0, subset=list(levels))


def resample_weeks(df: DataFrame, time: str, measures: dict[str, Column], trim: bool = True) -> DataFrame:
    """Sums per Monday week; ``trim`` drops the first and last bucket, which may be partial."""
    weeks = df.groupBy(F.date_trunc("week", F.col(time)).cast("date").alias("week")).agg(
        *[F.sum(c).alias(name) for name, c in measures.items()]
    )
    return drop_ends(weeks, "week") if trim else weeks


def drop_ends(df: DataFrame, key: str) -> DataFrame:
    """Drop the rows at the smallest and largest key (one-row bounds, broadcast)."""
    bounds = df.agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    inside = (F.col(key) > F.col("_lo")) & (F.col(key) < F.col("_hi"))
    return df.crossJoin(F.broadcast(bounds)).filter(inside).drop("_lo", "_hi")


def exact_percentiles(df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Interpolated percentiles (by..., p, value), exact, without sorting the table or gathering a group."""
    return order_statistics(df, [column], probs, by).drop("column")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles, max: one row per column."""
    require_columns(df, columns)
    stats = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        stats.append(F.struct(F.lit(c).alias("column"), F.count(v).alias("n"), F.avg(v).alias("mean"),
                              F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")).alias(f"_{i}"))
    basic = df.agg(*stats).select(F.explode(F.array(*[F.col(f"_{i}") for i in range(len(columns))])).alias("r")).select("r.*")
    quartiles = order_statistics(df, columns, [0.25, 0.5, 0.75]).groupBy("column").agg(
        *[F.max(F.when(F.col("p") == q, F.col("value"))).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)])
    return basic.join(quartiles, "column", "left").select("column", "n", "mean", "std", "min", "p25", "p50", "p75", "max")


def group_profile(df: DataFrame, key: str, collect: str, first: str, first_by: str) -> DataFrame:
    """Count, collected values and first value (by a stated key) per group.

    The collected list is kept as value counts, which merge map-side: a group of a billion
    rows with few distinct values stays small. The sorted list is written out from them.
    """
    per_value = df.groupBy(key, collect).agg(
        F.count(F.lit(1)).alias("_n"), F.min_by(first, first_by).alias("_f"), F.min(first_by).alias("_k")
    )
    return per_value.groupBy(key).agg(
        F.sum("_n").alias("count"),
        F.sort_array(F.collect_list(F.struct(F.col(collect).alias("value"), F.col("_n").alias("n")))).alias("values"),
        F.min_by("_f", "_k").alias("first_value"),
    )


def expand_counts(counts: Column) -> Column:
    """Sorted list with repeats from ``group_profile`` value counts."""
    return F.flatten(F.transform(counts, lambda p: F.array_repeat(p["value"], p["n"].cast("int"))))


def top_groups(df: DataFrame, key: str, k: int) -> DataFrame:
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), key).limit(k)


def head_and_tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First n and last n rows of a total order; each side is a distributed top-n."""
    first = df.orderBy(*[F.asc(c) for c in order]).limit(n).withColumn("side", F.lit("head"))
    last = df.orderBy(*[F.desc(c) for c in order]).limit(n).withColumn("side", F.lit("tail"))
    return first.unionByName(last)


def best_candidate(df: DataFrame, params: Sequence[str], score: str, by: Sequence[str] = ()) -> DataFrame:
    """Parameters with the smallest score; ties go to the smallest parameter tuple."""
    picked = F.min(F.struct(F.col(score), *[F.col(p) for p in params])).alias("_b")
    return df.filter(F.col(score).isNotNull()).groupBy(*by).agg(picked).select(
        *by, *[F.col(f"_b.{p}").alias(p) for p in params], F.col(f"_b.{score}").alias(score)
    )


def metric_table(df: DataFrame, actual: Column, predicted: Column, by: Sequence[str] = ()) -> DataFrame:
    """MAPE, MAE, RMSE, R2 and correlation in one aggregate. Zero actuals are left out of MAPE."""
    err = actual - predicted
    return df.groupBy(*by).agg(
        F.count(err).alias("n"),
        (F.avg(F.abs(F.try_divide(err, actual))) * 100).alias("mape"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.regr_syy(actual, predicted))).alias("r2"),
        F.try_divide(F.covar_pop(actual, predicted), F.stddev_pop(actual) * F.stddev_pop(predicted)).alias("correlation"),
    )
