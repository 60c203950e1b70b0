"""Penalised fits on wide designs that are expanded from a few columns inside Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from causeway.functions.stats import normal_quantile
from causeway.operators.gram import collect_gram, ridge, wide_gram
from causeway.session import require_columns


@dataclass(frozen=True)
class WideDesign:
    """Raw input columns, their expansion to k design columns, and named column blocks."""

    columns: tuple[str, ...]
    expand: Callable[[np.ndarray], np.ndarray]
    blocks: tuple[tuple[str, int], ...]

    @property
    def size(self) -> int:
        return sum(n for _, n in self.blocks)

    def block_slices(self) -> dict[str, slice]:
        out, start = {}, 0
        for name, n in self.blocks:
            out[name] = slice(start, start + n)
            start += n
        return out

    def gram(self, df: DataFrame, target: str, centre: float, scale: float, by: Sequence[str] = ()) -> DataFrame:
        expand = self.expand

        def with_target(x):
            return np.column_stack([expand(x[:, :-1]), (x[:, -1] - centre) / scale])

        return wide_gram(df, [*self.columns, target], with_target, by)


@dataclass(frozen=True)
class WideFit:
    design: WideDesign
    target: str
    centre: float
    scale: float
    coef: np.ndarray
    inverse: np.ndarray
    sigma2: float
    n: int

    def predict(self, df: DataFrame, level: float = 0.95, components: bool = False, prefix: str = "") -> DataFrame:
        """Rows plus mean and interval, and the partial sum of each block when asked."""
        require_columns(df, self.design.columns)
        names = [f"{prefix}mean", f"{prefix}lower", f"{prefix}upper"]
        slices = self.design.block_slices()
        if components:
            names += [f"{prefix}{b}" for b in slices]
        schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
        expand, coef, inverse, sigma2 = self.design.expand, self.coef, self.inverse, self.sigma2
        centre, scale, z = self.centre, self.scale, normal_quantile(0.5 + level / 2)

        @F.pandas_udf(schema)
        def score(*columns: pd.Series) -> pd.DataFrame:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            design = np.column_stack([np.ones(len(x)), expand(x)])
            mean = design @ coef
            half = z * np.sqrt(sigma2 * (1.0 + np.einsum("ij,jk,ik->i", design, inverse, design).clip(0.0)))
            out = {names[0]: mean * scale + centre, names[1]: (mean - half) * scale + centre,
                   names[2]: (mean + half) * scale + centre}
            if components:
                for name, s in slices.items():
                    part = slice(s.start + 1, s.stop + 1)
                    out[f"{prefix}{name}"] = design[:, part] @ coef[part] * scale
            return pd.DataFrame(out)

        scored = df.withColumn("_s", score(*[F.col(c).cast("double") for c in self.design.columns]))
        return scored.select(*df.columns, *[F.col(f"_s.{n}").alias(n) for n in names])


def solve_wide(gram: np.ndarray, penalty: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Coefficients, inverse, residual variance and effective parameters."""
    coef, inverse, rss = ridge(gram, penalty)
    n = gram[0, 0]
    edf = float(np.trace(inverse @ gram[:-1, :-1]))
    return coef, inverse, rss / max(n - edf, 1.0), edf


def fit_wide(df: DataFrame, design: WideDesign, target: str, penalty: np.ndarray,
             centre: float, scale: float) -> WideFit:
    gram = collect_gram(design.gram(df, target, centre, scale), design.size + 2)
    coef, inverse, sigma2, _ = solve_wide(gram, penalty)
    return WideFit(design, target, centre, scale, coef, inverse, sigma2, int(gram[0, 0]))
