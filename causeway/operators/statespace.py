"""Exact Gaussian likelihood of ARMA errors by a Kalman filter that runs in blocks.

The gains of the filter follow from the parameters and the position alone, so a step is an affine map of the
state. A block of a series composes its maps; the blocks' entering states are chained, and a second pass
filters every block from its state. Target and regressors pass the same filter, and the sums of products
of their innovations, added over blocks, give coefficients, variance and likelihood at once. A series
may have any number of blocks; (series, candidate) pairs are independent.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from causeway.operators.gram import field_list
from causeway.session import cut_lineage

BLOCK = 4096  # rows of a series that one task filters
RADIUS = 0.98  # roots of estimated polynomials are drawn to this distance from the unit circle


def damped(poly: np.ndarray) -> np.ndarray:
    """Coefficients c of 1 - c1 B - c2 B^2 ... with all inverse roots within ``RADIUS``."""
    poly = np.asarray(poly, float)
    if np.abs(poly).sum() < RADIUS:
        return poly
    n = len(poly)
    companion = np.zeros((n, n))
    companion[0] = poly
    companion[np.arange(1, n), np.arange(n - 1)] = 1.0
    radius = np.abs(np.linalg.eigvals(companion)).max()
    return poly if radius <= RADIUS else poly * (RADIUS / radius) ** np.arange(1, n + 1)


class ArmaFilter:
    """w_t = sum phi_i w_{t-i} + e_t + sum theta_j e_{t-j}, started from its stationary distribution.

    ``gain[t]`` and ``spread[t]`` (prediction variance in units of the shocks') are listed until they are constant.
    """

    def __init__(self, phi: Sequence[float], theta: Sequence[float], n: int):
        size = max(len(phi), len(theta) + 1)
        self.phi, load = np.zeros(size), np.zeros(size)
        self.phi[:len(phi)], load[0], load[1:len(theta) + 1] = phi, 1.0, theta
        shock = np.outer(load, load)
        move = np.zeros((size, size))
        move[:, 0] = self.phi
        move[np.arange(size - 1), np.arange(1, size)] = 1.0
        variance, power = shock, move
        for _ in range(60):  # doubling: 2^k terms of the sum of move^i shock move'^i
            added = power @ variance @ power.T
            variance = variance + added
            power = power @ power
            if np.abs(added).max() <= 1e-16 * np.abs(variance).max():
                break
        gains, spreads = [], []
        for _ in range(max(n, 1)):
            spread = variance[0, 0]
            gain = (self.phi * variance[0, 0] + np.append(variance[1:, 0], 0.0)) / spread
            gains.append(gain)
            spreads.append(spread)
            ahead = np.outer(self.phi, variance[0]) + np.vstack([variance[1:], np.zeros(size)])
            ahead = np.outer(ahead[:, 0], self.phi) + np.column_stack([ahead[:, 1:], np.zeros(size)])
            after = ahead + shock - np.outer(gain, gain) * spread
            done = np.abs(after - variance).max() <= 1e-14 * max(1.0, np.abs(variance).max())
            variance = (after + after.T) / 2
            if done:
                break
        self.gain, self.spread, self.size = np.array(gains), np.array(spreads), size

    def at(self, positions: np.ndarray) -> np.ndarray:
        return np.minimum(positions, len(self.spread) - 1)

    def run(self, rows: np.ndarray, start: int, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Innovations of ``rows`` (one series a column) from position ``start`` on, and the state after them."""
        out = np.empty_like(rows)
        phi, last = self.phi[:, None], len(self.gain) - 1
        for i, row in enumerate(rows):
            out[i] = row - state[0]
            moved = phi * state[0]
            moved[:-1] += state[1:]
            state = moved + np.outer(self.gain[min(start + i, last)], out[i])
        return out, state

    def composed(self, rows: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        """(matrix, offset): the state after the rows is matrix @ state + offset."""
        k = rows.shape[1]
        both = np.column_stack([rows, np.zeros((len(rows), self.size))])
        state = np.column_stack([np.zeros((self.size, k)), np.eye(self.size)])
        after = self.run(both, start, state)[1]
        return after[:, k:], after[:, :k]

    def sums(self, innovations: np.ndarray, start: int) -> tuple[float, np.ndarray]:
        """Sum of log variances and of products of standardised innovations."""
        spread = self.spread[self.at(start + np.arange(len(innovations)))]
        scaled = innovations / np.sqrt(spread)[:, None]
        return float(np.log(spread).sum()), scaled.T @ scaled


def profile(n: float, log_spread: float, products: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
    """(log-likelihood, variance, coefficients, their covariance) from summed products of [target, regressors]."""
    yy, xy, xx = products[0, 0], products[0, 1:], products[1:, 1:]
    unit = np.sqrt(np.clip(np.diag(xx), 1e-300, None))
    inverse = np.linalg.pinv(xx / np.outer(unit, unit), rcond=1e-12, hermitian=True) / np.outer(unit, unit)
    beta = inverse @ xy
    variance = max(float(yy - 2 * beta @ xy + beta @ xx @ beta), 1e-300) / n
    return -0.5 * n * (np.log(2 * np.pi * variance) + 1) - 0.5 * log_spread, variance, beta, inverse * variance


def _filtered(series: DataFrame, params: DataFrame, keys: Sequence[str], columns: Sequence[str], work, schema: T.StructType) -> DataFrame:
    """``work(key values, rows frame, one candidate's row, filter)`` for each (series, block, candidate)."""
    by = [*keys, "_block"]

    def meet(key, rows, own):
        out = []
        if len(rows):
            rows = rows.sort_values("_pos")
            values, end = rows[list(columns)].to_numpy(float), int(rows["_pos"].iloc[-1]) + 1
            for r in own.itertuples(index=False):
                out += work(tuple(key), rows, values, r, ArmaFilter(r.phi, r.theta, end))
        return pd.DataFrame(out, columns=[f.name for f in schema])

    return series.groupBy(*by).cogroup(params.groupBy(*by)).applyInPandas(meet, schema)


def _blocked(series: DataFrame, params: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Series rows with ``_block``, and a row per (candidate, block) with the state that enters the block."""
    block = F.floor(F.col("_pos") / BLOCK).cast("bigint")
    rows = cut_lineage(series.select(*keys, "_pos", *columns).withColumn("_block", block))
    spans = rows.select(*keys, "_block").distinct()
    own = cut_lineage(params.select(*keys, "candidate", "phi", "theta").join(spans, list(keys)))
    if rows.filter("_block > 0").isEmpty():
        return rows, own.withColumn("state", F.lit(None).cast("array<double>"))
    doubles = T.ArrayType(T.DoubleType())
    k = len(columns)
    schema = T.StructType([*field_list(own, keys), T.StructField("candidate", T.LongType()), T.StructField("_block", T.LongType()),
                           T.StructField("matrix", doubles), T.StructField("offset", doubles)])

    def compose(key, _, values, r, own_filter):
        matrix, offset = own_filter.composed(values, key[-1] * BLOCK)
        return [[*key[:-1], r.candidate, key[-1], matrix.ravel().tolist(), offset.ravel().tolist()]]

    maps = _filtered(rows, own, keys, columns, compose, schema)
    chained = T.StructType([*schema.fields[:-2], T.StructField("state", doubles)])

    def chain(key, pdf):
        out, state = [], None
        for r in pdf.sort_values("_block").to_dict("records"):
            offset = np.asarray(r["offset"]).reshape(-1, k)
            state = np.zeros_like(offset) if state is None else state
            out.append([*key, r["_block"], state.ravel().tolist()])
            state = np.asarray(r["matrix"]).reshape(len(offset), -1) @ state + offset
        return pd.DataFrame(out, columns=[f.name for f in chained])

    states = maps.groupBy(*keys, "candidate").applyInPandas(chain, chained)
    return rows, cut_lineage(own.join(states, [*keys, "candidate", "_block"], "left"))


def _entering(r, size: int, k: int) -> np.ndarray:
    return np.zeros((size, k)) if r.state is None else np.asarray(r.state, float).reshape(size, k)


def exact_fits(series: DataFrame, params: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys..., candidate, n, loglik, variance, beta[], covariance[]) for each (series, candidate).

    ``series`` has the rows (keys..., _pos, columns...): positions from 0 and the target before the
    regressors, without nulls; ``params`` (keys..., candidate, phi[], theta[]) with stationary ``phi``.
    """
    k = len(columns)
    rows, own = _blocked(series, params, keys, columns)
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([*field_list(own, keys), T.StructField("candidate", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("log_spread", T.DoubleType()), T.StructField("products", doubles)])

    def add(key, _, values, r, own_filter):
        innovations, _ = own_filter.run(values, key[-1] * BLOCK, _entering(r, own_filter.size, k))
        log_spread, products = own_filter.sums(innovations, key[-1] * BLOCK)
        return [[*key[:-1], r.candidate, len(values), log_spread, products.ravel().tolist()]]

    sums = _filtered(rows, own, keys, columns, add, schema).groupBy(*keys, "candidate").agg(
        F.sum("n").alias("n"), F.sum("log_spread").alias("log_spread"),
        F.array(*[F.sum(F.col("products")[i]) for i in range(k * k)]).alias("products"))
    out = T.StructType([*field_list(own, keys), T.StructField("candidate", T.LongType()), T.StructField("n", T.LongType()),
                        T.StructField("loglik", T.DoubleType()), T.StructField("variance", T.DoubleType()),
                        T.StructField("beta", doubles), T.StructField("covariance", doubles)])
    names = list(keys)

    def solve(batches):
        for pdf in batches:
            found = []
            for r in pdf.to_dict("records"):
                loglik, variance, beta, covariance = profile(r["n"], r["log_spread"], np.asarray(r["products"]).reshape(k, k))
                found.append([*[r[c] for c in names], r["candidate"], r["n"], loglik, variance, beta.tolist(), covariance.ravel().tolist()])
            yield pd.DataFrame(found, columns=[f.name for f in out])

    return sums.mapInPandas(solve, out)


def innovations(series: DataFrame, params: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys..., _pos, shock[], spread): each row's innovations of target and regressors, and their variance factor."""
    k = len(columns)
    rows, own = _blocked(series, params, keys, columns)
    schema = T.StructType([*field_list(own, keys), T.StructField("_pos", T.LongType()),
                           T.StructField("shock", T.ArrayType(T.DoubleType())), T.StructField("spread", T.DoubleType())])

    def emit(key, frame, values, r, own_filter):
        start = key[-1] * BLOCK
        found, _ = own_filter.run(values, start, _entering(r, own_filter.size, k))
        spread = own_filter.spread[own_filter.at(start + np.arange(len(values)))]
        return [[*key[:-1], int(p), v.tolist(), float(f)] for p, v, f in zip(frame["_pos"], found, spread, strict=True)]

    return _filtered(rows, own, keys, columns, emit, schema)


def maximise(series: DataFrame, starts: DataFrame, keys: Sequence[str], columns: Sequence[str], ar: Sequence[int], ma: Sequence[int],
             rounds: int = 12, step: float = 0.2, least: float = 1e-4) -> DataFrame:
    """Maximum-likelihood ``phi`` and ``theta`` of each series by a pattern search from ``starts`` (keys..., point[]).

    A point lists the coefficients at the lags ``ar`` and ``ma``. A round evaluates, in one job, steps of five lengths
    both ways along each coefficient, and each series goes to its best one; where none is better the
    steps shrink. Ends when no series steps on, or after ``rounds``. Returns (keys..., candidate, phi[], theta[]).
    """
    size = len(ar) + len(ma)
    doubles = T.ArrayType(T.DoubleType())
    names = list(keys)
    table = T.StructType([*field_list(starts, keys), T.StructField("candidate", T.LongType()), T.StructField("phi", doubles),
                          T.StructField("theta", doubles), T.StructField("point", doubles), T.StructField("step", T.DoubleType())])

    def around(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                centre, h = np.asarray(r["point"], float), r["step"]
                moves = [centre] + [centre + sign * h * 0.25**j * np.eye(size)[i] for i in range(size) for j in range(5) for sign in (1, -1)]
                for c, point in enumerate(moves):
                    phi, theta = polynomials(point, ar, ma)
                    out.append([*[r[n] for n in names], c, phi.tolist(), theta.tolist(), unpacked(phi, theta, ar, ma).tolist(), h])
            yield pd.DataFrame(out, columns=[f.name for f in table])

    now = cut_lineage(starts.select(*keys, "point").withColumn("step", F.lit(float(step))))
    for _ in range(rounds if size else 0):
        tried = cut_lineage(now.mapInPandas(around, table))
        scored = exact_fits(series, tried, keys, columns).select(*keys, "candidate", "loglik")
        best = tried.join(scored, [*keys, "candidate"]).groupBy(*keys).agg(
            F.max(F.struct("loglik", (-F.col("candidate")).alias("order"), "point", "step")).alias("b"))
        now = cut_lineage(best.select(*keys, F.col("b.point").alias("point"), F.when(
            F.col("b.order") == 0, F.col("b.step") / 8).otherwise(F.col("b.step")).alias("step")))
        if now.filter(F.col("step") >= least).isEmpty():
            break

    def last(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                phi, theta = polynomials(np.asarray(r["point"], float), ar, ma)
                out.append([*[r[n] for n in names], 0, phi.tolist(), theta.tolist()])
            yield pd.DataFrame(out, columns=[*names, "candidate", "phi", "theta"])

    return now.mapInPandas(last, T.StructType(table.fields[:-2]))


def polynomials(point: np.ndarray, ar: Sequence[int], ma: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Dense (phi, theta) from coefficients at lags, drawn inside the unit circle."""
    phi, theta = np.zeros(max(ar, default=0)), np.zeros(max(ma, default=0))
    phi[[i - 1 for i in ar]] = point[:len(ar)]
    theta[[i - 1 for i in ma]] = point[len(ar):]
    return damped(phi), -damped(-theta)


def unpacked(phi: np.ndarray, theta: np.ndarray, ar: Sequence[int], ma: Sequence[int]) -> np.ndarray:
    return np.concatenate([phi[[i - 1 for i in ar]] if ar else [], theta[[i - 1 for i in ma]] if ma else []])
