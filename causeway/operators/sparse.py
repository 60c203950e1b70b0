"""Least squares with category columns of any number of levels.

Levels lie in a table with a code each; a row's dummies are its codes, never columns. The normal equations are
sparse sums: dense by dense on the driver, level by dense and level by level as tables, each from one
combined aggregate. They are solved by conjugate gradients: a product of matrix and vector is a join of the level
pairs with the vector and a sum, and only the dense block and one-row sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causeway.operators.gram import complete_rows, linear_expression
from causeway.operators.ordered import row_number
from causeway.session import cut_lineage, require_columns

TOLERANCE = 1e-12  # residual relative to the right side, in units of the diagonal
ROUNDS = 500


def level_table(df: DataFrame, columns: Sequence[str], drop_first: bool = True) -> DataFrame:
    """(column, level, code): the distinct values of text columns with dense codes from 0, by column and value.

    The first value of a column is its base and has no row. Nulls are no level.
    """
    require_columns(df, columns)
    if not columns:
        return df.sparkSession.createDataFrame([], "column int, level string, code bigint")
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"`{c}`").cast("string").alias("level")) for i, c in enumerate(columns)]))
    found = df.select(pairs.alias("p")).select("p.*").filter(F.col("level").isNotNull()).distinct()
    if drop_first:
        base = found.groupBy("column").agg(F.min("level").alias("_base"))  # a row per column
        found = found.join(F.broadcast(base), "column").filter("level != _base").drop("_base")
    return row_number(found, [], [F.col("column"), F.col("level")], "code").withColumn("code", F.col("code") - 1)


def encode(df: DataFrame, levels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``_k0, _k1, ...``: the code of each column's value, null for the base, nulls and unknown values.

    Joins on the values leave hot ones to the adaptive skew split.
    """
    for i, c in enumerate(columns):
        own = levels.filter(F.col("column") == i).select(F.col("level").alias("_level"), F.col("code").alias(f"_k{i}"))
        df = df.join(own, F.col(f"`{c}`").cast("string") == F.col("_level"), "left").drop("_level")
    return df


def sparse_one_hot(df: DataFrame, columns: Sequence[str], name: str = "active") -> tuple[DataFrame, DataFrame]:
    """``df`` with the ascending codes of its dummies as an array instead of ``columns``, and the level table."""
    levels = cut_lineage(level_table(df, columns))
    coded = encode(df, levels, columns)
    codes = F.array_sort(F.filter(F.array(*[F.col(f"_k{i}") for i in range(len(columns))]), lambda k: k.isNotNull()))
    return coded.select(*[c for c in df.columns if c not in columns], codes.alias(name)), levels


@dataclass(frozen=True)
class NormalEquations:
    """X'X and X'y of [dense, levels]: ``dense`` and ``cross`` on the driver, the rest as tables.

    ``diagonal`` has (code, n, y, s0, s1, ...): rows, target sum and dense sums of each level; ``pairs`` has
    (code, other, n) for levels of different columns, both ways.
    """

    dense: np.ndarray
    cross: np.ndarray
    yy: float
    n: int
    diagonal: DataFrame
    pairs: DataFrame | None


def normal_equations(coded: DataFrame, dense: Sequence[str], target: str, n_columns: int) -> NormalEquations:
    p = len(dense)
    x = [F.col(f"`{c}`").cast("double") for c in dense]
    y = F.col(f"`{target}`").cast("double")
    row = coded.agg(
        *[F.sum(x[i] * x[j]).alias(f"d{i}_{j}") for i in range(p) for j in range(i, p)],
        *[F.sum(x[i] * y).alias(f"c{i}") for i in range(p)], F.sum(y * y).alias("yy"), F.count(F.lit(1)).alias("n")).collect()[0]
    if not row["n"]:
        raise ValueError("no rows to fit")
    square = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            square[i, j] = square[j, i] = row[f"d{i}_{j}"]
    sums = ", ".join(["n double", "y double", *[f"s{j} double" for j in range(p)]])
    diagonal, pairs = coded.sparkSession.createDataFrame([], f"code bigint, {sums}"), None
    for i in range(n_columns):
        own = coded.filter(F.col(f"_k{i}").isNotNull()).groupBy(F.col(f"_k{i}").alias("code")).agg(
            F.count(F.lit(1)).cast("double").alias("n"), F.sum(y).alias("y"), *[F.sum(v).alias(f"s{j}") for j, v in enumerate(x)])
        diagonal = diagonal.unionByName(own)
        for j in range(i):
            both = coded.filter(F.col(f"_k{i}").isNotNull() & F.col(f"_k{j}").isNotNull()).groupBy(
                F.col(f"_k{i}").alias("code"), F.col(f"_k{j}").alias("other")).agg(F.count(F.lit(1)).cast("double").alias("n"))
            both = both.unionByName(both.select(F.col("other").alias("code"), F.col("code").alias("other"), "n"))
            pairs = both if pairs is None else pairs.unionByName(both)
    return NormalEquations(square, np.array([row[f"c{i}"] for i in range(p)]), float(row["yy"]), int(row["n"]),
                           cut_lineage(diagonal), None if pairs is None else cut_lineage(pairs))


def _sums(table: DataFrame, values: dict[str, Column]) -> dict[str, float]:
    row = table.agg(*[F.coalesce(F.sum(v), F.lit(0.0)).alias(name) for name, v in values.items()]).collect()[0]
    return row.asDict()


def solve_sparse(e: NormalEquations, inverse: bool = True, tolerance: float = TOLERANCE, rounds: int = ROUNDS):
    """(dense coefficients, level table (code, coef, i0, ...), inverse's dense block or None, rounds used).

    ``i0, i1, ...`` are the level's rows of the inverse's dense columns.

    All right sides, the target's and one per dense column for the inverse, go through the same jobs. The diagonal is the
    preconditioner. Collinear columns get one of the solutions. Raises if ``rounds`` don't reach ``tolerance``.
    """
    p = len(e.dense)
    sides = 1 + (p if inverse else 0)
    R = range(sides)
    scale = np.where(np.diag(e.dense) > 0, np.diag(e.dense), 1.0)
    top = np.zeros((p, sides))
    top[:, 0] = e.cross
    if inverse:
        top[:, 1:] = np.eye(p)
    x, r = np.zeros((p, sides)), top.copy()
    now = e.diagonal.select("*", *[F.lit(0.0).alias(f"x{k}") for k in R],
                            *[(F.col("y") if k == 0 else F.lit(0.0)).alias(f"r{k}") for k in R])
    z = r / scale[:, None]
    now = cut_lineage(now.withColumns({f"p{k}": F.col(f"r{k}") / F.col("n") for k in R}))
    sums = _sums(now, {f"k{k}": F.col(f"r{k}") * F.col(f"r{k}") / F.col("n") for k in R})
    rho = np.array([sums[f"k{k}"] for k in R]) + (r * z).sum(0)
    goal, step = np.maximum(rho, 1e-300) * tolerance**2, z
    done = 0
    while (rho > goal).any():
        if done == rounds:
            raise ValueError(f"no solution within {rounds} rounds")
        done += 1
        own = {f"q{k}": F.col("n") * F.col(f"p{k}") + linear_expression(step[:, k], [F.col(f"s{j}") for j in range(p)]) for k in R}
        table = now.withColumns(own)
        if e.pairs is not None:
            moved = e.pairs.join(now.select(F.col("code").alias("other"), *[f"p{k}" for k in R]), "other").groupBy("code").agg(
                *[F.sum(F.col("n") * F.col(f"p{k}")).alias(f"m{k}") for k in R])
            table = table.join(moved, "code", "left").withColumns({
                f"q{k}": F.col(f"q{k}") + F.coalesce(f"m{k}", F.lit(0.0)) for k in R}).drop(*[f"m{k}" for k in R])
        table = cut_lineage(table)
        sums = _sums(table, {**{f"k{k}": F.col(f"p{k}") * F.col(f"q{k}") for k in R},
                             **{f"s{j}_{k}": F.col(f"s{j}") * F.col(f"p{k}") for j in range(p) for k in R}})
        q = e.dense @ step + np.array([[sums[f"s{j}_{k}"] for k in R] for j in range(p)]).reshape(p, sides)
        along = np.array([sums[f"k{k}"] for k in R]) + (step * q).sum(0)
        live = (rho > goal) & (along > 0)
        alpha = np.where(live, rho / np.where(along > 0, along, 1.0), 0.0)
        x, r = x + alpha * step, r - alpha * q
        now = table.withColumns({**{f"x{k}": F.col(f"x{k}") + float(alpha[k]) * F.col(f"p{k}") for k in R},
                                 **{f"r{k}": F.col(f"r{k}") - float(alpha[k]) * F.col(f"q{k}") for k in R}})
        sums = _sums(now, {f"k{k}": F.col(f"r{k}") * F.col(f"r{k}") / F.col("n") for k in R})
        z = r / scale[:, None]
        after = np.array([sums[f"k{k}"] for k in R]) + (r * z).sum(0)
        beta = np.where(live, after / rho, 0.0)
        rho = np.where(live, after, np.minimum(rho, goal))
        step = z + beta * step
        now = now.withColumns({f"p{k}": F.col(f"r{k}") / F.col("n") + float(beta[k]) * F.col(f"p{k}") for k in R}).drop(*[f"q{k}" for k in R])
    block = x[:, 1:] if inverse else None
    return x[:, 0], now.select("code", F.col("x0").alias("coef"), *[F.col(f"x{k}").alias(f"i{k - 1}") for k in R if k]), block, done


@dataclass(frozen=True)
class SparseFit:
    """Coefficients of the dense terms on the driver, those of the levels as a table (column, level, code, coef, i0, ...).

    ``covariance`` is that of the dense coefficients.
    """

    dense: tuple[str, ...]
    categories: tuple[str, ...]
    target: str
    coef: np.ndarray
    inverse: np.ndarray
    covariance: np.ndarray
    sigma2: float
    n_obs: int
    rounds: int
    levels: DataFrame = field(compare=False, repr=False)

    @property
    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.dense, map(float, self.coef), strict=True))

    def coefficient_table(self, spark) -> DataFrame:
        """(ord, term, coef, std_error, statistic) of the dense terms."""
        rows = []
        for i, term in enumerate(self.dense):
            se = float(np.sqrt(max(self.covariance[i, i], 0.0)))
            rows.append((i, term, float(self.coef[i]), se, float(self.coef[i] / se) if se else None))
        return spark.createDataFrame(rows, "ord int, term string, coef double, std_error double, statistic double")

    def _with_levels(self, df: DataFrame, values: Sequence[str]) -> tuple[DataFrame, list[Column]]:
        """Rows joined with their levels, and for each of the level table's ``values`` its sum over a row's levels."""
        require_columns(df, [*self.dense, *self.categories])
        out, sums = encode(df, self.levels, self.categories), [F.lit(0.0) for _ in values]
        for i in range(len(self.categories)):
            own = self.levels.select(F.col("code").alias(f"_k{i}"), *[F.col(v).alias(f"_{v}_{i}") for v in values])
            out = out.join(own, f"_k{i}", "left")
            sums = [total + F.coalesce(f"_{v}_{i}", F.lit(0.0)) for total, v in zip(sums, values, strict=True)]
        return out, sums

    def mean(self, df: DataFrame, zero: Sequence[str] = (), name: str = "mean") -> DataFrame:
        """``df`` with the prediction; terms in ``zero`` count as zero, base and unknown levels add nothing."""
        out, (levels,) = self._with_levels(df, ["coef"])
        x = [F.col(f"`{t}`") for t in self.dense]
        total = linear_expression([0.0 if t in zero else c for t, c in zip(self.dense, self.coef, strict=True)], x)
        return out.withColumn(name, total + levels).select(*df.columns, name)

    def influence(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        """``df`` with a column per dense coefficient: how much it moves with the row's target."""
        p = len(self.dense)
        out, levels = self._with_levels(df, [f"i{j}" for j in range(p)])
        x = [F.col(f"`{t}`") for t in self.dense]
        names = [f"_h{j}" for j in range(p)]
        moved = {name: linear_expression(self.inverse[:, j], x) + levels[j] for j, name in enumerate(names)}
        return out.withColumns(moved).select(*df.columns, *names), names


def fit_sparse(df: DataFrame, dense: Sequence[str], categories: Sequence[str], target: str) -> SparseFit:
    """Least squares of ``target`` on dense columns (give a constant as one) and dummies of text columns.

    Rows with nulls are left out. The first level of each category is the base.
    """
    rows = complete_rows(df.select(*dict.fromkeys([*dense, *categories, target])), [*dense, *categories, target])
    levels = cut_lineage(level_table(rows, categories))
    coded = cut_lineage(encode(rows, levels, categories).select(
        *dict.fromkeys([*dense, target]), *[f"_k{i}" for i in range(len(categories))]))
    e = normal_equations(coded, dense, target, len(categories))
    coef, found, inverse, used = solve_sparse(e)
    named = cut_lineage(levels.join(found, "code").select("column", "level", *found.columns))
    fit = SparseFit(tuple(dense), tuple(categories), target, coef, inverse, inverse, float("nan"), e.n, used, named)
    error = F.col(target) - F.col("_mean")
    rss = fit.mean(rows, name="_mean").agg(F.sum(error * error).alias("rss")).collect()[0]["rss"]
    free = e.n - len(dense) - e.diagonal.count()
    sigma2 = rss / free if free > 0 else float("nan")
    return replace(fit, covariance=inverse * sigma2, sigma2=sigma2)
