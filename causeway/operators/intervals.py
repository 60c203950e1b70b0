"""Fits on many time windows from one read of the rows.

All window ends cut time into elementary intervals. Rows are reduced to (group, time) cells, cells get the
running row count of their group from a scan, and one pass gives the moments of (time, running count,
values) per (group, interval). A candidate window is a run of intervals: its moments are merged from
theirs, centred, so nothing is lost by subtraction; its own origin of time and count is a shift. Work on
rows doesn't depend on the number of candidates.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from causeway.operators.gram import Moments, complete_rows, field_list
from causeway.operators.ordered import affine_scan
from causeway.session import cut_lineage, require_columns

Window = tuple[float, float, float]  # (from, to, point): rows with from <= time < to, split at point


def time_cells(df: DataFrame, time: str, values: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by..., _t, _n, _mean[], _cov[]): count and moments of the values of each (group, time); one combined aggregate."""
    require_columns(df, [time, *values, *by])
    columns = [F.col(f"`{c}`").cast("double") for c in values]
    k = len(values)
    return complete_rows(df, [time, *values]).groupBy(*by, F.col(time).cast("double").alias("_t")).agg(
        F.count(F.lit(1)).alias("_n"), F.array(*[F.avg(c) for c in columns]).alias("_mean"),
        F.array(*[F.covar_pop(columns[i], columns[j]) for i in range(k) for j in range(k)]).alias("_cov"))


def _merged(n: np.ndarray, mean: np.ndarray, m2: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Count, mean and centred cross-products of the union of parts."""
    total = n.sum()
    if not total:
        return 0.0, np.zeros(mean.shape[1]), np.zeros((mean.shape[1],) * 2)
    centre = n @ mean / total
    away = mean - centre
    return float(total), centre, m2.sum(0) + (n[:, None] * away).T @ away


def interval_moments(df: DataFrame, time: str, values: Sequence[str], marks: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(by..., interval, n, first, before, mean[], m2[]): parts of the moments of (time, count, values).

    ``interval`` is the number of marks up to the time, ``first`` the part's first time and ``before`` the
    group's rows before it. A part is what one task saw in one batch; merge parts of an interval.
    """
    cells = time_cells(df, time, values, by)
    scanned = affine_scan(cells, list(by), [F.col("_t")], {"_count": (F.lit(1.0), F.col("_n"))})
    edges, k, keys = np.unique(np.asarray(marks, float)), len(values), list(by)
    schema = T.StructType([
        *field_list(cells, keys), T.StructField("interval", T.IntegerType()),
        *[T.StructField(c, T.DoubleType()) for c in ("n", "first", "before")], *_arrays("mean", "m2")])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            t, n, count = (batch.column(c).to_numpy().astype(float) for c in ("_t", "_n", "_count"))
            z = np.column_stack([t, count, batch.column("_mean").flatten().to_numpy().reshape(-1, k)])
            inner = np.zeros((len(t), k + 2, k + 2))
            inner[:, 2:, 2:] = batch.column("_cov").flatten().to_numpy().reshape(-1, k, k)
            interval = np.searchsorted(edges, t, "right")
            group = np.zeros(len(t), int)
            for c in keys:
                group = group * (len(t) + 1) + np.asarray(batch.column(c).dictionary_encode(null_encoding="encode").indices)
                group = np.unique(group, return_inverse=True)[1]
            label = np.unique(group * (len(edges) + 1) + interval, return_inverse=True)[1]
            order = np.argsort(label, kind="stable")
            starts = np.flatnonzero(np.diff(label[order], prepend=-1))
            picked = [order[a:b] for a, b in zip(starts, [*starts[1:], len(order)], strict=True)]
            found = [_merged(n[i], z[i], n[i, None, None] * inner[i]) for i in picked]
            first = np.array([i[t[i].argmin()] for i in picked])
            columns = [*[batch.column(c).take(pa.array(first)) for c in keys], pa.array(interval[first], pa.int32()),
                       pa.array([f[0] for f in found]), pa.array(t[first]), pa.array(count[first] - n[first]),
                       pa.array([f[1].tolist() for f in found], pa.list_(pa.float64())),
                       pa.array([f[2].ravel().tolist() for f in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return scanned.mapInArrow(run, schema)


def _arrays(*names: str) -> list[T.StructField]:
    return [T.StructField(c, T.ArrayType(T.DoubleType())) for c in names]


def _upper(matrix: np.ndarray) -> np.ndarray:
    return matrix[np.triu_indices(len(matrix))]


def window_moments(df: DataFrame, time: str, values: Sequence[str], windows: Sequence[Window], by: Sequence[str]) -> DataFrame:
    """(by..., candidate, pre[], post[], at[]) of every group with rows in a window.

    ``pre`` and ``post`` hold count, sums and cross-products (upper triangle) of (t, w, values) before the
    point and from it on: ``t`` counts from 1 at the group's first time in the window, ``w`` is the running
    number of the group's rows since the point, 0 before it; rows that share a time share it. Values are
    taken from the overall mean ``at``, so the sums can be added over groups.
    """
    keys, k = list(by), len(values)
    ends = sorted({v for w in windows for v in w})
    parts = cut_lineage(interval_moments(df, time, values, ends, keys))
    totals = parts.agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col("mean")[2 + i]).alias(f"s{i}") for i in range(k)]).collect()[0]
    origin = np.array([totals[f"s{i}"] / totals["n"] for i in range(k)]) if totals["n"] else np.zeros(k)
    place = {v: i + 1 for i, v in enumerate(ends)}
    plan = [(c, *(place[v] for v in w)) for c, w in enumerate(windows)]
    schema = T.StructType([*field_list(parts, keys), T.StructField("candidate", T.LongType()), *_arrays("pre", "post", "at")])
    group = keys or ["_one"]
    parts = parts if keys else parts.withColumn("_one", F.lit(1))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["interval", "first"])
        interval, n = pdf["interval"].to_numpy(), pdf["n"].to_numpy()
        first, before = pdf["first"].to_numpy(), pdf["before"].to_numpy()
        mean = np.stack(pdf["mean"].to_list())
        m2 = np.stack(pdf["m2"].to_list()).reshape(len(pdf), k + 2, k + 2)
        out = []
        for candidate, lo, hi, point in plan:
            a, p, b = (int(np.searchsorted(interval, x)) for x in (lo, min(max(point, lo), hi), hi))
            if a == b:
                continue
            row = []
            for x, y, counted in ((a, p, False), (p, b, True)):
                total, centre, inner = _merged(n[x:y], mean[x:y], m2[x:y])
                if not counted:
                    inner[1, :] = inner[:, 1] = 0.0
                if total:
                    shift = np.concatenate([[first[a] - 1.0, before[x] if counted else centre[1]], origin])
                    centre = centre - shift
                row.append([total, *(total * centre), *_upper(inner + total * np.outer(centre, centre))])
            out.append([candidate, *row, origin.tolist()])
        found = pd.DataFrame(out, columns=["candidate", "pre", "post", "at"])
        for i, c in enumerate(keys):
            found.insert(i, c, [pdf[c].iloc[0]] * len(found))
        return found

    return parts.groupBy(*group).applyInPandas(run, schema)


def moments_of(sums: Sequence[float], names: Sequence[str], origin: Sequence[float]) -> Moments:
    """Moments of (t, w, values) from added-up ``pre`` or ``post`` sums."""
    k, s = len(names), np.asarray(sums, float)
    n = s[0]
    if not n:
        return Moments(tuple(names), 0.0, np.zeros(k), np.zeros((k, k)))
    mean, full = s[1:1 + k] / n, np.zeros((k, k))
    full[np.triu_indices(k)] = s[1 + k:] / n
    full = full + np.triu(full, 1).T
    return Moments(tuple(names), float(n), mean + np.concatenate([[0.0, 0.0], origin]), full - np.outer(mean, mean))


def added(frame: DataFrame, columns: Sequence[str], size: int, by: Sequence[str]) -> DataFrame:
    """Element-wise sums of array columns; one combined aggregate."""
    sums = frame.groupBy(*by).agg(*[F.sum(F.col(c)[i]).alias(f"_{c}_{i}") for c in columns for i in range(size)])
    return sums.select(*by, *[F.array(*[F.col(f"_{c}_{i}") for i in range(size)]).alias(c) for c in columns])
