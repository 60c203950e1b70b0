"""Column expressions: dates, logs, dummies, encoders, scalers, calendar terms."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causeway.session import require_columns


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Calendar date from text; text that is not a date gives null."""
    return F.try_to_date(text, pattern)


def axis_to_date(value: Column, origin: Column, base: str = "2000-01-01") -> Column:
    """Date for a numeric time axis: base date plus whole days since the origin."""
    return F.date_add(F.lit(base).cast("date"), (value - origin).cast("int"))


def require_positive(df: DataFrame, columns: Sequence[str]) -> None:
    """One aggregate over all columns; raises where a logarithm would be undefined."""
    require_columns(df, columns)
    low = df.agg(*[F.min(c).alias(c) for c in columns]).first()
    bad = [c for c in columns if low[c] is not None and low[c] <= 0]
    if bad:
        raise ValueError(f"values must be positive for a logarithm: {bad}")


def interval_dummy(time: Column, start, end=None) -> Column:
    """1 inside ``[start, end)``, open to the right when ``end`` is None, else 0."""
    inside = time >= F.lit(start)
    if end is not None:
        inside = inside & (time < F.lit(end))
    return inside.cast("int")


def period_index(time: Column, points: Sequence[float]) -> Column:
    """0 before the first point, i from the i-th point (1-based) to the next."""
    index = F.lit(0)
    for i, point in enumerate(sorted(points), start=1):
        index = F.when(time >= F.lit(point), F.lit(i)).otherwise(index)
    return F.when(time.isNotNull(), index)


def period_label(time: Column, points: Sequence[float]) -> Column:
    index = period_index(time, points)
    return F.when(index == 0, F.lit("Pre-intervention")).otherwise(
        F.concat(F.lit("Intervention_D_"), index.cast("string"))
    )


def hill(x: Column, half: float, slope: float) -> Column:
    """Saturation x^s / (x^s + k^s); 0 where x is 0."""
    powered = F.pow(x, F.lit(float(slope)))
    return F.when(x <= 0, F.lit(0.0)).otherwise(powered / (powered + F.lit(float(half) ** float(slope))))


def hinge(t: Column, knot: float) -> Column:
    return F.greatest(t - F.lit(float(knot)), F.lit(0.0))


def fourier(t: Column, period: float, order: int) -> list[Column]:
    terms = []
    for k in range(1, order + 1):
        angle = t * F.lit(2.0 * math.pi * k / period)
        terms += [F.sin(angle), F.cos(angle)]
    return terms


def month_trend(date: Column, trend: Column) -> list[Column]:
    """Trend interacted with each of the twelve month dummies."""
    return [F.when(F.month(date) == m, trend).otherwise(F.lit(0.0)) for m in range(1, 13)]


def even_grid(df: DataFrame, low: Column, high: Column, n: int, name: str = "x") -> DataFrame:
    """Explode each row into ``n`` evenly spaced values over [low, high]."""
    step = F.lit(0.0) if n == 1 else (high - low) / F.lit(float(n - 1))
    points = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: low + i.cast("double") * step)
    return df.withColumn(name, F.explode(points))


def value_map(column: Column, mapping: dict) -> Column:
    """Mapped value, null where the key is unknown."""
    out = F.lit(None)
    for key, value in mapping.items():
        out = F.when(column == F.lit(key), F.lit(value)).otherwise(out)
    return out


def ordinal(column: Column, levels: Sequence[str]) -> Column:
    """Zero-based position in ``levels``; an unknown level raises at run time, null stays null."""
    position = F.array_position(F.array(*[F.lit(v) for v in levels]), column)
    return F.when(column.isNull(), F.lit(None).cast("bigint")).otherwise(
        F.when(position > 0, position - 1).otherwise(
            F.raise_error(F.concat(F.lit("unknown level: "), column)).cast("bigint")
        )
    )


class TooManyLevels(ValueError):
    """A category has more levels than dummies as columns are made for; ``operators.sparse`` takes any number."""


@dataclass(frozen=True)
class OneHot:
    """Category levels learned once; first sorted level is the base."""

    levels: dict[str, tuple[str, ...]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], max_levels: int = 200) -> OneHot:
        """Levels per column from one grouped pass. More than the cap don't become columns: see ``operators.sparse``."""
        require_columns(df, columns)
        if not columns:
            return cls({})
        pairs = F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)
        ]))
        found = (
            df.select(pairs.alias("p")).select("p.i", "p.v").filter(F.col("v").isNotNull())
            .distinct().limit(max_levels * len(columns) + 1).collect()
        )
        levels = {c: tuple(sorted(r.v for r in found if r.i == i)) for i, c in enumerate(columns)}
        if len(found) > max_levels * len(columns) or any(len(v) > max_levels for v in levels.values()):
            raise TooManyLevels(f"more than {max_levels} levels in one of {list(columns)}; operators.sparse fits and encodes them")
        return cls(levels)

    @property
    def names(self) -> list[str]:
        return [f"{c}_{v}" for c, values in self.levels.items() for v in values[1:]]

    def expressions(self) -> list[Column]:
        return [
            F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
            for c, values in self.levels.items() for v in values[1:]
        ]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(dict(zip(self.names, self.expressions(), strict=True)))


def string_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


@dataclass(frozen=True)
class MeanScaler:
    """Divide by the training mean; the inverse multiplies it back."""

    means: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> MeanScaler:
        require_columns(df, columns)
        row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
        zero = [c for c in columns if not row[c]]
        if zero:
            raise ValueError(f"mean is zero or missing: {zero}")
        return cls({c: float(row[c]) for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c) / F.lit(m) for c, m in self.means.items()})

    def inverse(self, df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
        """Rescale; ``columns`` maps an output column to the fitted column it is measured in."""
        pairs = columns or {c: c for c in self.means}
        return df.withColumns({out: F.col(out) * F.lit(self.means[src]) for out, src in pairs.items()})
