"""Cross-product aggregates and the small solves behind every linear fit.

A fit is one aggregate over the rows (map-side combined, so a hot group costs one
partial row per task) followed by a k x k solve. Up to ``NATIVE_LIMIT`` variables the
aggregate is Spark's own ``covar_pop``, which merges centred co-moments and stays
accurate for large means. Wider designs are expanded in Arrow batches and summed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from causeway.functions.stats import normal_two_sided, t_two_sided
from causeway.operators.ordered import ordered_scan
from causeway.session import require_columns

NATIVE_LIMIT = 14


@dataclass(frozen=True)
class Moments:
    """Count, means and centred second moments (divided by n) of named variables."""

    names: tuple[str, ...]
    n: float
    mean: np.ndarray
    cov: np.ndarray

    def index(self, name: str) -> int:
        return self.names.index(name)

    def average(self, name: str) -> float:
        return float(self.mean[self.index(name)])


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a null (or NaN) in the columns a fit uses."""
    return df.dropna(subset=list(dict.fromkeys(columns)))


def moment_columns(names: Sequence[str]) -> list[Column]:
    cols = [F.count(F.lit(1)).alias("m_n")]
    values = [F.col(f"`{c}`").cast("double") for c in names]
    cols += [F.avg(v).alias(f"m_mean_{i}") for i, v in enumerate(values)]
    cols += [
        F.covar_pop(values[i], values[j]).alias(f"m_cov_{i}_{j}")
        for i in range(len(names)) for j in range(i, len(names))
    ]
    return cols


def moments_by(df: DataFrame, names: Sequence[str], by: Sequence[str] = (), extra: Sequence[Column] = ()) -> DataFrame:
    """One row of moments per group; a single aggregate with partial combine."""
    require_columns(df, [*names, *by])
    return complete_rows(df, names).groupBy(*by).agg(*moment_columns(names), *extra)


def moments_from_row(row, names: Sequence[str]) -> Moments:
    k = len(names)
    n = float(row["m_n"] or 0)
    if n == 0:
        return Moments(tuple(names), 0.0, np.zeros(k), np.zeros((k, k)))
    mean = np.array([row[f"m_mean_{i}"] for i in range(k)], dtype=float)
    cov = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            cov[i, j] = cov[j, i] = row[f"m_cov_{i}_{j}"]
    return Moments(tuple(names), n, mean, cov)


def moments(df: DataFrame, names: Sequence[str]) -> Moments:
    if len(names) > NATIVE_LIMIT:
        return _wide_moments(df, names)
    return moments_from_row(moments_by(df, names).collect()[0], names)


def _wide_moments(df: DataFrame, names: Sequence[str]) -> Moments:
    clean = complete_rows(df, names)
    row = clean.agg(
        *[F.avg(F.col(f"`{c}`").cast("double")).alias(f"a{i}") for i, c in enumerate(names)],
        *[F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}") for i, c in enumerate(names)],
    ).collect()[0]
    centre = np.array([row[f"a{i}"] or 0.0 for i in range(len(names))])
    scale = np.array([row[f"s{i}"] or 1.0 for i in range(len(names))])
    raw = collect_gram(wide_gram(clean, names, lambda x: (x - centre) / scale), len(names) + 1)
    n = raw[0, 0]
    shift = raw[0, 1:] / n
    cov = (raw[1:, 1:] / n - np.outer(shift, shift)) * np.outer(scale, scale)
    return Moments(tuple(names), n, centre + shift * scale, cov)


def _wide_moments_by(df: DataFrame, names: Sequence[str], by: Sequence[str]):
    """A row per group for any number of variables, and the function that reads moments from it.

    Cross-products are summed in units of the overall spread around the overall mean, so little is lost.
    """
    clean = complete_rows(df, names)
    row = clean.agg(
        *[F.avg(F.col(f"`{c}`").cast("double")).alias(f"a{i}") for i, c in enumerate(names)],
        *[F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}") for i, c in enumerate(names)]).collect()[0]
    centre = np.array([row[f"a{i}"] or 0.0 for i in range(len(names))])
    scale = np.array([row[f"s{i}"] or 1.0 for i in range(len(names))])

    def read(found, names) -> Moments:
        raw = unpack_gram(np.asarray(found["entries"], float), len(names) + 1)
        n = raw[0, 0]
        shift = raw[0, 1:] / n
        cov = (raw[1:, 1:] / n - np.outer(shift, shift)) * np.outer(scale, scale)
        return Moments(tuple(names), float(n), centre + shift * scale, cov)

    return pack_by(wide_gram(clean, names, lambda x: (x - centre) / scale, by), by), read


def merge_moments(parts: Iterable[Moments]) -> Moments:
    parts = [p for p in parts if p.n > 0]
    if not parts:
        raise ValueError("no rows to fit")
    n = sum(p.n for p in parts)
    mean = sum(p.n * p.mean for p in parts) / n
    cov = sum(p.n * (p.cov + np.outer(p.mean - mean, p.mean - mean)) for p in parts) / n
    return Moments(parts[0].names, n, mean, cov)


@dataclass(frozen=True)
class Solution:
    """Least-squares result; the constant comes first when there is one."""

    terms: tuple[str, ...]
    coef: np.ndarray
    inverse: np.ndarray
    rank: int
    n: float
    rss: float
    tss: float

    @property
    def dof(self) -> float:
        return self.n - self.rank

    @property
    def sigma2(self) -> float:
        return self.rss / self.dof if self.dof > 0 else float("nan")

    @property
    def covariance(self) -> np.ndarray:
        return self.inverse * self.sigma2


def solve(m: Moments, features: Sequence[str], target: str, intercept: bool = True) -> Solution:
    """Least squares from moments, in standardised scale.

    A rank-deficient design gets the minimum-norm coefficients in raw scale, the
    constant included, and the reduced rank is reported.
    """
    if m.n == 0:
        raise ValueError("no rows to fit")
    ix = [m.index(f) for f in features]
    iy = m.index(target)
    mean, my = m.mean[ix], m.mean[iy]
    cross = m.cov[np.ix_(ix, ix)]
    with_y = m.cov[ix, iy]
    yy = m.cov[iy, iy]
    if not intercept:
        cross = cross + np.outer(mean, mean)
        with_y = with_y + mean * my
        yy = yy + my * my
    k = len(ix)
    spread = np.sqrt(np.clip(np.diag(cross), 0.0, None)) if k else np.zeros(0)
    level = np.maximum(np.abs(mean), 1.0) if k else np.zeros(0)
    live = spread > 1e-12 * level
    unit = np.where(live, spread, 1.0)
    scaled = cross / np.outer(unit, unit) if k else np.zeros((0, 0))
    scaled[~live, :] = 0.0
    scaled[:, ~live] = 0.0
    values, vectors = np.linalg.eigh(scaled) if k else (np.zeros(0), np.zeros((0, 0)))
    keep = values > 1e-10 * max(values.max(initial=0.0), 1e-300)
    good = vectors[:, keep]
    inner = good @ np.diag(1.0 / values[keep]) @ good.T if k else np.zeros((0, 0))
    inner = inner / np.outer(unit, unit) / m.n if k else inner
    slope = inner @ (with_y * m.n) if k else np.zeros(0)
    null = vectors[:, ~keep] / unit[:, None] if k else np.zeros((0, 0))
    if intercept:
        lead = np.concatenate([[my - mean @ slope], slope])
        inverse = np.zeros((k + 1, k + 1))
        inverse[1:, 1:] = inner
        inverse[0, 1:] = inverse[1:, 0] = -mean @ inner
        inverse[0, 0] = 1.0 / m.n + mean @ inner @ mean
        null = np.vstack([-mean @ null, null]) if null.size else np.zeros((k + 1, 0))
    else:
        lead, inverse = slope, inner
    if null.shape[1]:
        basis, _ = np.linalg.qr(null)
        project = np.eye(len(lead)) - basis @ basis.T
        lead = project @ lead
        inverse = project @ inverse @ project.T
    rss = float(m.n * max(yy - with_y @ slope, 0.0))
    terms = (("const",) if intercept else ()) + tuple(features)
    return Solution(terms, lead, inverse, int(keep.sum()) + int(intercept), m.n, rss, float(m.n * yy))


def term_rows(s: Solution, covariance: np.ndarray | None = None, normal: bool = False) -> list[tuple]:
    """(term, coef, std_error, statistic, p_value) per term."""
    cov = s.covariance if covariance is None else covariance
    rows = []
    for i, term in enumerate(s.terms):
        se = float(np.sqrt(max(cov[i, i], 0.0))) if np.isfinite(cov[i, i]) else float("nan")
        stat = float(s.coef[i] / se) if se > 0 else float("nan")
        p = normal_two_sided(stat) if normal else t_two_sided(stat, s.dof)
        rows.append((term, float(s.coef[i]), se, stat, float(p)))
    return rows


TERM_SCHEMA = "term string, coef double, std_error double, statistic double, p_value double"


def field_list(df: DataFrame, columns: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(c, df.schema[c].dataType, True) for c in columns]


FIT_FIELDS = [
    T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("inverse", T.ArrayType(T.DoubleType())),
    T.StructField("rss", T.DoubleType()),
    T.StructField("tss", T.DoubleType()),
    T.StructField("rank", T.LongType()),
    T.StructField("n_obs", T.LongType()),
]


def fit_by(
    df: DataFrame, features: Sequence[str], target: str, by: Sequence[str], intercept: bool = True
) -> DataFrame:
    """One least-squares fit per group, lazily: (by..., coef[], inverse[], rss, tss, rank, n_obs)."""
    names = [*features, target]
    stats, read = moments_by(df, names, by), moments_from_row
    if len(names) > NATIVE_LIMIT:
        stats, read = _wide_moments_by(df, names, by)
    schema = T.StructType(field_list(df, by) + FIT_FIELDS)
    keys, wanted = list(by), list(features)

    def solve_rows(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                s = solve(read(row, names), wanted, target, intercept)
                out.append([row[c] for c in keys] + [
                    s.coef.tolist(), s.inverse.ravel().tolist(), s.rss, s.tss, s.rank, int(s.n),
                ])
            yield pd.DataFrame(out, columns=keys + [f.name for f in FIT_FIELDS])

    return stats.mapInPandas(solve_rows, schema)


def coefficient_rows(fits: DataFrame, terms: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Long form (by..., term, coef, std_error, statistic, n_obs) of grouped fits."""
    k = len(terms)
    sigma2 = F.try_divide(F.col("rss"), (F.col("n_obs") - F.col("rank")).cast("double"))
    entries = F.explode(F.array(*[
        F.struct(
            F.lit(i).alias("ord"), F.lit(t).alias("term"), F.col("coef")[i].alias("c"),
            F.sqrt(F.greatest(F.col("inverse")[i * k + i] * sigma2, F.lit(0.0))).alias("se"),
        ) for i, t in enumerate(terms)
    ]))
    return fits.select(*by, "n_obs", entries.alias("e")).select(
        *by, F.col("e.ord").alias("ord"), F.col("e.term").alias("term"), F.col("e.c").alias("coef"),
        F.col("e.se").alias("std_error"), F.try_divide("e.c", "e.se").alias("statistic"), "n_obs",
    )


def linear_expression(coef: Sequence[Column | float], values: Sequence[Column]) -> Column:
    total = None
    for c, v in zip(coef, values, strict=True):
        part = (c if isinstance(c, Column) else F.lit(float(c))) * v.cast("double")
        total = part if total is None else total + part
    return F.lit(0.0) if total is None else total


def apply_fit(
    df: DataFrame, fits: DataFrame, features: Sequence[str], by: Sequence[str], name: str,
    intercept: bool = True, coef: str = "coef",
) -> DataFrame:
    """Join group coefficients and add the fitted value. AQE picks the join from real sizes."""
    slim = fits.select(*[F.col(c).alias(f"_f_{c}") for c in by], F.col(coef).alias("_coef"))
    match = None
    for c in by:
        one = F.col(c).eqNullSafe(F.col(f"_f_{c}"))
        match = one if match is None else match & one
    values = ([F.lit(1.0)] if intercept else []) + [F.col(f"`{f}`") for f in features]
    fitted = linear_expression([F.col("_coef")[i] for i in range(len(values))], values)
    return df.join(slim, match).select(*df.columns, fitted.alias(name))


# ---------------------------------------------------------------- wide designs


def wide_gram(
    df: DataFrame, columns: Sequence[str], expand: Callable[[np.ndarray], np.ndarray],
    by: Sequence[str] = (),
) -> DataFrame:
    """Entries of Z'Z per group, Z = [1, expand(columns)], as (by..., pos, value).

    Only the raw columns cross into Python; each task keeps running sums and flushes
    them, so a task holds at most ``FLUSH`` groups. ``pos`` runs over the upper triangle.
    """
    require_columns(df, [*columns, *by])
    keys = list(by)
    schema = T.StructType(field_list(df, keys) + [T.StructField("entries", T.ArrayType(T.DoubleType()))])
    arrow_schema = pa.schema(
        [pa.field(c, _arrow_type(df.schema[c].dataType)) for c in keys]
        + [pa.field("entries", pa.list_(pa.float64()))]
    )
    names = list(columns)

    def flush(sums):
        items = list(sums.items())
        arrays = [pa.array([k[i] for k, _ in items], type=arrow_schema.field(i).type) for i in range(len(keys))]
        arrays.append(pa.array([v[np.triu_indices(len(v))].tolist() for _, v in items], type=pa.list_(pa.float64())))
        return pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    def run(batches):
        sums: dict = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = np.column_stack([
                batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(float)
                for c in names
            ])
            z = np.column_stack([np.ones(len(x)), expand(x)])
            for key, rows in _rows_by_key(batch, keys):
                part = z[rows]
                sums[key] = sums.get(key, 0.0) + part.T @ part
                if len(sums) >= FLUSH:
                    yield flush(sums)
                    sums = {}
        if sums:
            yield flush(sums)

    source = complete_rows(df, names).select(
        *keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in names]
    )
    parts = source.mapInArrow(run, schema)
    return (
        parts.select(*keys, F.posexplode("entries").alias("pos", "value"))
        .groupBy(*keys, "pos").agg(F.sum("value").alias("value"))
    )


FLUSH = 64


def _rows_by_key(batch: pa.RecordBatch, keys: list[str]):
    if not keys:
        yield (), slice(None)
        return
    frame = pd.DataFrame({c: batch.column(batch.schema.get_field_index(c)).to_pandas() for c in keys})
    for key, rows in frame.groupby(keys, dropna=False, sort=False).indices.items():
        key = key if isinstance(key, tuple) else (key,)
        yield tuple(None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in key), rows


def _arrow_type(kind: T.DataType) -> pa.DataType:
    table = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    return table[kind.simpleString()]


def unpack_gram(values: np.ndarray, size: int) -> np.ndarray:
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = values
    return full + np.triu(full, 1).T


def collect_gram(frame: DataFrame, size: int) -> np.ndarray:
    """Gram matrix on the driver: at most size*(size+1)/2 numbers."""
    rows = frame.collect()
    if not rows:
        raise ValueError("no rows to fit")
    values = np.zeros(size * (size + 1) // 2)
    for r in rows:
        values[r["pos"]] = r["value"]
    return unpack_gram(values, size)


def pack_by(frame: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group with its entries in ``pos`` order."""
    packed = frame.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("e"))
    return packed.select(*by, F.col("e.value").alias("entries"))


def ridge(gram: np.ndarray, penalty: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Penalised fit from Z'Z with Z = [1, X, y]: coefficients, (X'X+P)^-1, residual sum of squares.

    ``penalty`` is a vector or matrix over the X columns; the constant is never penalised.
    """
    full = np.zeros((gram.shape[0] - 1, gram.shape[0] - 1))
    pen = np.diag(penalty) if np.ndim(penalty) == 1 else penalty
    full[1:, 1:] = pen
    xx, xy, yy = gram[:-1, :-1], gram[:-1, -1], gram[-1, -1]
    inverse = np.linalg.pinv(xx + full, rcond=1e-13, hermitian=True)
    coef = inverse @ xy
    rss = float(yy - 2 * coef @ xy + coef @ xx @ coef)
    return coef, inverse, max(rss, 0.0)


# ---------------------------------------------------------------- robust errors


def newey_west(
    df: DataFrame, terms: Sequence[Column], residual: Column, order: Column,
    by: Sequence[str], lags: int, inverse: np.ndarray, bucketed: bool = False,
) -> np.ndarray:
    """HAC covariance with Bartlett weights; lags never cross groups.

    The Bartlett sum equals the mean outer product of rolling score sums of length lags + 1
    over the zero-padded series, so one moment aggregate replaces one per lag.
    ``bucketed`` promises one row per (group, time): a window then holds buckets only. Without it
    rows get positions from an ordered scan and each adds its score to the next ``lags`` positions,
    keyed by (group, position), so a long series is never gathered in one task.
    """
    k = len(terms)
    rolled = (_rolled_windows if bucketed else _rolled_positions)(df, terms, residual, order, list(by), lags)
    row = rolled.agg(*[
        F.sum(F.col(f"_a{i}") * F.col(f"_a{j}")).alias(f"g_{i}_{j}") for i in range(k) for j in range(i, k)
    ]).collect()[0]
    meat = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            meat[i, j] = meat[j, i] = (row[f"g_{i}_{j}"] or 0.0) / (lags + 1.0)
    return inverse @ meat @ inverse


def _rolled_positions(df, terms, residual, order, by, lags) -> DataFrame:
    k = len(terms)
    scores = df.select(
        *by, order.alias("_order"), *[(t.cast("double") * residual).alias(f"_u{i}") for i, t in enumerate(terms)])
    scores = scores.withColumn("_tie", F.xxhash64(*[f"_u{i}" for i in range(k)]))
    placed = ordered_scan(scores, by, [F.col("_order"), F.col("_tie")], position="_pos")
    spread = placed.withColumn("_at", F.explode(F.sequence(F.col("_pos"), F.col("_pos") + lags)))
    return spread.groupBy(*by, "_at").agg(*[F.sum(f"_u{i}").alias(f"_a{i}") for i in range(k)])


def _rolled_windows(df, terms, residual, order, by, lags) -> DataFrame:
    """Every row gives the sum of the next ``lags`` scores; the first ``lags`` rows also their prefix sum."""
    k = len(terms)
    scores = df.select(
        *by, order.alias("_order"), *[(t.cast("double") * residual).alias(f"_u{i}") for i, t in enumerate(terms)]
    )
    series = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_order")
    ahead, back = series.rowsBetween(0, lags), series.rowsBetween(-lags, 0)
    rolled = scores.select(
        (F.row_number().over(series) <= lags).alias("_early"),
        F.struct(*[F.sum(f"_u{i}").over(ahead).alias(f"_a{i}") for i in range(k)]).alias("_ahead"),
        F.struct(*[F.sum(f"_u{i}").over(back).alias(f"_a{i}") for i in range(k)]).alias("_back"),
    )
    both = F.explode(F.array(F.col("_ahead"), F.when(F.col("_early"), F.col("_back"))))
    return rolled.select(both.alias("_s")).filter(F.col("_s").isNotNull()).select("_s.*")
