"""Exact order statistics by bit histograms that are refined from the top bits down.

Doubles map to 64-bit numbers in the same order. A level counts the values by their next bits and keeps only the
buckets that hold a wanted rank; three levels fix all bits. Every level is one read of the rows and one combined
aggregate for all columns, probabilities and groups; a bucket table has at most 2^22 rows per wanted
bucket whatever the rows, and no value is sorted with others.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causeway.session import cut_lineage, require_columns

LEVELS = (44, 22, 0)  # bits below those counted in each level: 20, then 22, then 22


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Signed 64-bit numbers in the order of the doubles; both zeros are one."""
    bits = (np.asarray(x, float) + 0.0).view(np.int64)
    return np.where(bits < 0, np.int64(-(2**63)) - bits - 1, bits)


def doubles_of(bits: np.ndarray) -> np.ndarray:
    bits = np.asarray(bits, np.int64)
    return np.where(bits < 0, np.int64(-(2**63)) - bits - 1, bits).view(float)


def _same(by: Sequence[str], left: str = "") -> Column:
    out = F.lit(True)
    for c in by:
        out = out & F.col(f"{left}{c}").eqNullSafe(F.col(f"_g_{c}"))
    return out


def _keyed(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by..., _i, _key) of every value that is neither null nor NaN."""
    k, names = len(columns), list(by)
    rows = df.select(*names, *[F.col(f"`{c}`").cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            kept = [batch.column(c) for c in names]
            keys = []
            for i in range(k):
                x = batch.column(f"_v{i}").to_numpy(zero_copy_only=False).astype(float)
                keys.append(pa.array(ordered_bits(x), pa.int64(), mask=np.isnan(x)))
            yield pa.RecordBatch.from_arrays([*kept, *keys], [*names, *[f"_v{i}" for i in range(k)]])

    schema = rows.select(*names).schema
    for i in range(k):
        schema = schema.add(f"_v{i}", "long")
    coded = rows.mapInArrow(run, schema)
    values = F.filter(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(f"_v{i}").alias("_key")) for i in range(k)]), lambda s: s["_key"].isNotNull())
    return coded.select(*names, F.explode(values).alias("_s")).select(*names, "_s.*")


def order_statistics(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, p, value): exact percentiles with linear interpolation between neighbouring ranks.

    Nulls and NaN are no values; a group without any has no row for that column.
    """
    require_columns(df, [*columns, *by])
    keyed, keys = _keyed(df, columns, by), [*by, "_i"]
    wanted = None  # (keys..., _rank, _p, _side, _low): the rank inside the bucket whose first key is _low
    for level, shift in enumerate(LEVELS):
        bucket = F.shiftright("_key", shift)
        if level:
            live = wanted.select(*[F.col(c).alias(f"_g_{c}") for c in keys], "_bucket").distinct()
            rows = keyed.withColumn("_up", F.shiftright("_key", LEVELS[level - 1]))
            match = _same(keys) & (F.col("_up") == F.col("_bucket"))
            rows = rows.join(live if by else F.broadcast(live), match)  # without groups: two buckets per column and probability
            counts = rows.groupBy(*keys, "_up", bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        else:
            counts = keyed.withColumn("_up", F.lit(0).cast("bigint")).groupBy(*keys, "_up", bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy(*keys, "_up").orderBy("_b")  # at most 2^22 rows of a bucket
        counts = cut_lineage(counts.withColumn("_to", F.sum("_n").over(upto)))
        if not level:
            sizes = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
            asked = F.explode(F.array(*[F.struct(F.lit(j).alias("_p"), F.lit(float(p)).alias("_prob")) for j, p in enumerate(probs)])).alias("_q")
            spot = F.col("_prob") * (F.col("_total") - 1)
            sides = F.explode(F.array(F.struct(F.lit(0).alias("_side"), F.floor(spot).alias("_rank")), F.struct(F.lit(1).alias("_side"), F.ceil(spot).alias("_rank")))).alias("_s")
            wanted = sizes.select("*", asked).select(*keys, "_total", "_q.*").withColumn("_share", spot - F.floor(spot)).select("*", sides).select(
                *keys, "_p", "_prob", "_share", F.lit(0).cast("bigint").alias("_bucket"), "_s.*")
        found = counts.select(*[F.col(c).alias(f"_g_{c}") for c in keys], "_up", "_b", "_n", "_to")
        inside = _same(keys) & (F.col("_bucket") == F.col("_up")) & (F.col("_rank") >= F.col("_to") - F.col("_n")) & (F.col("_rank") < F.col("_to"))
        wanted = cut_lineage(wanted.join(found, inside).select(
            *keys, "_p", "_prob", "_share", F.col("_b").alias("_bucket"), "_side", (F.col("_rank") - F.col("_to") + F.col("_n")).alias("_rank")))
    low, high = (F.max(F.when(F.col("_side") == s, F.col("_bucket"))).alias(n) for s, n in ((0, "_low"), (1, "_high")))
    pairs = wanted.groupBy(*keys, "_p", "_prob", "_share").agg(low, high)
    names, told = list(by), list(columns)

    def values(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = (doubles_of(batch.column(c).to_numpy()) for c in ("_low", "_high"))
            share = batch.column("_share").to_numpy()
            with np.errstate(invalid="ignore"):
                value = np.where(a == b, a, a + share * (b - a))
            columns = pa.array([told[i] for i in batch.column("_i").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], columns, batch.column("_prob"), pa.array(value)], [*names, "column", "p", "value"])

    schema = pairs.select(*names).schema.add("column", "string").add("p", "double").add("value", "double")
    return pairs.mapInArrow(values, schema)
