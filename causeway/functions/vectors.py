"""Array-column vector maths and coordinate-row matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm_l1(v: Column) -> Column:
    return _total(F.transform(v, lambda x: F.abs(x.cast("double"))))


def norm_l2(v: Column) -> Column:
    return F.sqrt(_total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def linear_map(v: Column, matrix: Sequence[Sequence[float]]) -> Column:
    """Product of a fixed matrix (rows) with a vector column."""
    return F.array(*[dot(F.array(*[F.lit(float(x)) for x in row]), v) for row in matrix])


def matrix_product(a: DataFrame, b: DataFrame) -> DataFrame:
    """Product of two ``(i, j, v)`` frames. Only stored cells are multiplied."""
    left = a.select(F.col("i"), F.col("j").alias("k"), F.col("v").alias("va"))
    right = b.select(F.col("i").alias("k"), F.col("j"), F.col("v").alias("vb"))
    return left.join(right, "k").groupBy("i", "j").agg(F.sum(F.col("va") * F.col("vb")).alias("v"))


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")
