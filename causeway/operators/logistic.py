"""Logistic regression without intercept under three penalties, and their comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from causeway.session import require_columns

PENALTIES = {"none": None, "l2_default": 1.0, "l2_tiny": 1e9}


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, strength: float | None = None,
                 max_iter: int = 1000, tol: float = 1e-12) -> dict[str, float]:
    """Coefficients by feature. ``strength`` is the inverse penalty C of ``|w|^2/2 + C * loss``.

    The estimator averages the loss over rows, hence ``regParam = 1 / (C n)``.
    """
    require_columns(df, [*features, label])
    rows = df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("_y")).dropna()
    data = VectorAssembler(inputCols=list(features), outputCol="_x").transform(rows).select("_x", "_y")
    reg = 0.0 if strength is None else 1.0 / (strength * data.count())
    model = LogisticRegression(
        featuresCol="_x", labelCol="_y", fitIntercept=False, standardization=False, regParam=reg,
        elasticNetParam=0.0, maxIter=max_iter, tol=tol, family="binomial").fit(data)
    return dict(zip(features, (float(c) for c in model.coefficients), strict=True))


def compare_penalties(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(features, none, l2_default, l2_tiny): one row per feature. Rows are kept for the three fits."""
    rows = df.select(*features, label).persist()
    try:
        fits = {name: fit_logistic(rows, features, label, c) for name, c in PENALTIES.items()}
    finally:
        rows.unpersist()
    return df.sparkSession.createDataFrame(
        [(f, *[fits[name][f] for name in PENALTIES]) for f in features],
        "features string, " + ", ".join(f"{name} double" for name in PENALTIES))
