"""Survival curves, log-rank, concordance and a discrete-time hazard forest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causeway.functions.stats import chi2_one_tail
from causeway.operators.ordered import ordered_scan, place, running
from causeway.session import require_columns


def _clean(df: DataFrame, time: str, event: str, keep: Sequence[str] = ()) -> DataFrame:
    require_columns(df, [time, event, *keep])
    return df.select(*keep, F.col(time).alias("time"), F.col(event).cast("boolean").alias("event")).dropna()


def survival_curve(df: DataFrame, time: str, event: str, by: Sequence[str] = ()) -> DataFrame:
    """Kaplan-Meier estimate at the distinct event times of each group.

    Rows shrink to (group, time) counts first; running totals then come from an ordered scan,
    so neither a hot group nor a fine time scale lands in one task.
    """
    cells = _clean(df, time, event, by).groupBy(*by, "time").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("event").cast("bigint")).alias("events"))
    # time runs backwards, so the running count is the number still at risk
    counted = ordered_scan(cells, by, [F.desc("time")], {"at_risk": F.col("_n")}, position=None)
    hits = counted.filter("events > 0")
    last = F.col("events") == F.col("at_risk")
    step = F.when(last, F.lit(0.0)).otherwise(F.log1p(-F.col("events") / F.col("at_risk")))
    placed = place(hits, by, [F.asc("time")])
    summed = running(placed, by, [F.asc("time")], {"_log": step, "_end": last.cast("int")})
    curve = F.when(F.col("_end") > 0, F.lit(0.0)).otherwise(F.exp("_log"))
    return summed.select(*by, "time", "at_risk", "events", curve.alias("survival"))


def log_rank(df: DataFrame, time: str, event: str, group: str, first, second) -> DataFrame:
    """Two-group log-rank: observed and expected events of the first, chi-square and p. One row."""
    rows = _clean(df, time, event, [group]).filter(F.col(group).isin(first, second))
    one = (F.col(group) == F.lit(first)).cast("bigint")
    hit = F.col("event").cast("bigint")
    cells = rows.groupBy("time").agg(
        F.sum(one).alias("_m1"), F.count(F.lit(1)).alias("_m"), F.sum(one * hit).alias("d1"), F.sum(hit).alias("d"))
    at = ordered_scan(cells, [], [F.desc("time")], {"n1": F.col("_m1"), "n": F.col("_m")}, position=None)
    share = F.col("n1") / F.col("n")
    spread = F.when(
        F.col("n") > 1, F.col("d") * share * (1 - share) * (F.col("n") - F.col("d")) / (F.col("n") - 1)).otherwise(0.0)
    row = at.agg(F.sum("d1").alias("o"), F.sum(F.col("d") * share).alias("e"), F.sum(spread).alias("v")).collect()[0]
    if not row["v"]:
        raise ValueError("no event time with both groups at risk")
    stat = (row["o"] - row["e"]) ** 2 / row["v"]
    return df.sparkSession.createDataFrame(
        [(int(row["o"]), float(row["e"]), float(row["v"]), float(stat), chi2_one_tail(stat))],
        "observed bigint, expected double, variance double, chi_square double, p_value double")


def concordance(df: DataFrame, time: str, event: str, risk: str) -> DataFrame:
    """Concordance of a risk score with survival, exact and without forming pairs.

    A pair counts when the earlier subject had the event; a censored subject at the same time
    counts as later. Higher risk for the earlier one is concordant, equal risk is half.

    Risks get dense integer codes. Two codes differ first at exactly one bit, so the pairs with
    ``risk_j < risk_i`` split by (bit, common leading bits): there it is enough to count zeros that
    come later in time. Each reduced row is emitted once per bit, and later counts are running sums.
    """
    rows = _clean(df, time, event, [risk]).withColumn("late", (~F.col("event")).cast("int"))
    cells = rows.groupBy(F.col(risk).cast("double").alias("risk"), "time", "late").agg(F.count(F.lit(1)).alias("n"))
    codes = ordered_scan(cells.select("risk").distinct(), [], [F.asc("risk")], position="code")
    codes = codes.select(F.col("risk").alias("_r"), (F.col("code") - 1).alias("code"))
    top = codes.agg(F.max("code").alias("m")).collect()[0]["m"]
    bits = int(top or 0).bit_length()
    coded = cells.join(codes, F.col("risk") == F.col("_r"))
    hit = F.when(F.col("late") == 0, F.col("n")).otherwise(F.lit(0))

    def share(kind: int, level: int, prefix: Column, earlier: Column, later: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(level).alias("level"), prefix.alias("prefix"),
                        earlier.alias("earlier"), later.alias("later"))

    parts = [
        share(0, 0, F.lit(0).cast("bigint"), hit, F.col("n")),  # all comparable pairs
        share(1, 0, F.col("code"), hit, F.col("n")),  # equal risk
    ]
    for b in range(bits):
        bit = F.shiftright("code", b).bitwiseAND(F.lit(1))
        parts.append(share(2, b, F.shiftright("code", b + 1), hit * bit, F.col("n") * (1 - bit)))
    spread = coded.select("time", "late", F.explode(F.array(*parts)).alias("p")).select("time", "late", "p.*")
    by = ["kind", "level", "prefix"]
    small = spread.groupBy(*by, "time", "late").agg(F.sum("earlier").alias("earlier"), F.sum("later").alias("later"))
    seen = ordered_scan(small, by, [F.desc("time"), F.desc("late")], {"_upto": F.col("later")}, position=None)
    pairs = F.col("earlier") * (F.col("_upto") - F.col("later"))
    counts = seen.agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == k, pairs)), F.lit(0)).alias(name)
        for k, name in enumerate(("comparable", "tied", "concordant"))])
    return counts.select(
        "comparable", "concordant", "tied",
        F.try_divide(F.col("concordant") + F.col("tied") * 0.5, F.col("comparable")).alias("concordance"))


# ---------------------------------------------------------------- hazard forest


@dataclass(frozen=True)
class HazardForest:
    """Discrete-time survival forest: a random forest on person-period rows.

    Stands in for a log-rank survival forest; the hazard of each period is a class probability.
    """

    features: tuple[str, ...]
    edges: tuple[float, ...]
    model: RandomForestClassificationModel

    @classmethod
    def fit(cls, df: DataFrame, features: Sequence[str], time: str, event: str, n_periods: int = 12,
            trees: int = 1000, min_leaf: int = 15, depth: int = 8, seed: int = 20) -> HazardForest:
        require_columns(df, [*features, time, event])
        rows = df.select(*features, F.col(time).cast("double").alias("_time"),
                         F.col(event).cast("boolean").alias("_event")).dropna()
        probs = [i / n_periods for i in range(1, n_periods)]
        row = rows.filter("_event").agg(F.percentile_approx("_time", probs, 10000).alias("q")).collect()[0]
        if not row["q"]:
            raise ValueError("no events to fit")
        edges = tuple(sorted(set(float(v) for v in row["q"])))
        own = _period_of(F.col("_time"), edges)
        spans = rows.withColumn("_own", own).withColumn("_period", F.explode(F.sequence(F.lit(0), F.col("_own"))))
        labelled = spans.withColumn(
            "_label", ((F.col("_period") == F.col("_own")) & F.col("_event")).cast("double"))
        vectors = _assembler(features).transform(labelled).select("_x", "_label")
        forest = RandomForestClassifier(
            featuresCol="_x", labelCol="_label", numTrees=trees, minInstancesPerNode=min_leaf,
            maxDepth=depth, seed=seed, subsamplingRate=1.0)
        return cls(tuple(features), edges, forest.fit(vectors))

    def curves(self, df: DataFrame, key: str) -> DataFrame:
        """(key, period, period_end, hazard, survival) for each row; null end is the open last period."""
        require_columns(df, [key, *self.features])
        n = len(self.edges) + 1
        rows = df.select(key, *self.features).withColumn("_period", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        scored = self.model.transform(_assembler(self.features).transform(rows))
        hazard = F.least(vector_to_array("probability")[1], F.lit(1.0 - 1e-12))
        ends = F.array(*[F.lit(e) for e in self.edges])
        # one window per subject holds the periods of that subject only
        upto = Window.partitionBy(key).orderBy("_period").rowsBetween(Window.unboundedPreceding, 0)
        return scored.select(key, "_period", hazard.alias("hazard")).select(
            key, F.col("_period").alias("period"), F.get(ends, F.col("_period")).alias("period_end"), "hazard",
            F.exp(F.sum(F.log1p(-F.col("hazard"))).over(upto)).alias("survival"))

    def risk(self, df: DataFrame, key: str) -> DataFrame:
        """(key, risk): cumulative hazard over all periods."""
        return self.curves(df, key).groupBy(key).agg(F.sum(-F.log1p(-F.col("hazard"))).alias("risk"))


def _period_of(time: Column, edges: Sequence[float]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < time))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[*features, "_period"], outputCol="_x")
