"""Exact choice under a cap: value-by-weight arrays combined by (max, +) convolution.

An option list says what each whole weight from 0 up to the cap is worth at best. Two lists combine to the best sum
of values over all splits of a weight. Lists are combined in a tree: a block of items in a task, then blocks of
blocks, so a group with very many items is spread, and no task holds more than a few lists of the cap's
length. Going back down, every node's weight is split among its children, to the items.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from causeway.operators.gram import field_list
from causeway.operators.ordered import row_number
from causeway.session import cut_lineage, require_columns

FAN = 64  # items of a block and blocks of a block of blocks


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Best value at each weight from two option lists of one length."""
    if np.isneginf(b).sum() > len(b) - 8:  # few options, as of a single item
        out = np.full(len(a), -np.inf)
        for w in np.flatnonzero(~np.isneginf(b)):
            out[w:] = np.maximum(out[w:], a[:len(a) - w] + b[w])
        return out
    out = np.full(len(a), -np.inf)
    for w in range(len(b)):
        out[w:] = np.maximum(out[w:], b[w] + a[:len(a) - w])
    return out


def split(lists: Sequence[np.ndarray], weight: int) -> list[int]:
    """Weight of each list in a best choice of at most ``weight``; of equal ones later lists get the least."""
    upto = [np.full(len(lists[0]), -np.inf)]
    upto[0][0] = 0.0
    for own in lists:
        upto.append(combined(upto[-1], own))
    total = upto[-1][:weight + 1]
    left, out = int(np.argmax(total)), []
    for before, own in zip(upto[-2::-1], lists[::-1], strict=True):
        w = np.arange(left + 1)
        value = before[left - w] + own[w]
        out.append(int(np.argmax(value)))
        left -= out[-1]
    return out[::-1]


def allocate(options: DataFrame, by: Sequence[str], cap: int) -> DataFrame:
    """``options`` (by..., item, values[]) with the ``weight`` of each item in a best choice, per group.

    ``values[w]`` is what the item is worth at weight w, null where it can't have it; index 0 must be there. Items
    are ordered by their names, so of equal choices the same comes out every time.
    """
    require_columns(options, [*by, "item", "values"])
    size, names = cap + 1, list(by)
    doubles = T.ArrayType(T.DoubleType())
    placed = row_number(options, names, [F.col("item")], "_pos").withColumn("_pos", F.col("_pos") - 1)
    nodes = [cut_lineage(placed.select(*names, "_pos", F.col("values").alias("_values")))]
    group = names or ["_one"]
    schema = T.StructType([*field_list(options, names), T.StructField("_pos", T.LongType()), T.StructField("_values", doubles)])

    def dense(values) -> np.ndarray:
        out = np.full(size, -np.inf)
        own = np.array([-np.inf if v is None or v != v else v for v in values[:size]], float)
        out[:len(own)] = own
        return out

    def keyed(df: DataFrame) -> DataFrame:
        return df if names else df.withColumn("_one", F.lit(0))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        total = dense([0.0])
        for values in pdf["_values"]:
            total = combined(total, dense(values))
        row = [*[pdf[c].iloc[0] for c in names], int(pdf["_pos"].iloc[0]) // FAN, total.tolist()]
        return pd.DataFrame([row], columns=[f.name for f in schema])

    while not nodes[-1].filter("_pos > 0").isEmpty():
        up = keyed(nodes[-1]).withColumn("_up", F.floor(F.col("_pos") / FAN))
        nodes.append(cut_lineage(up.groupBy(*group, "_up").applyInPandas(merge, schema)))
    told = T.StructType([*field_list(options, names), T.StructField("_pos", T.LongType()), T.StructField("weight", T.LongType())])

    def share(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        found = split([dense(v) for v in pdf["_values"]], int(pdf["_budget"].iloc[0]))
        out = pdf[[*names, "_pos"]].copy()
        out["weight"] = found
        return out

    budgets = keyed(nodes[-1]).select(*group, F.lit(0).cast("bigint").alias("_up"), F.lit(cap).cast("bigint").alias("_budget"))
    for level in reversed(nodes[:-1] or nodes):
        up = F.floor(F.col("_pos") / FAN).cast("bigint")
        below = keyed(level).withColumn("_up", up)
        match = F.col("_up") == F.col("_b_up")
        for c in group:
            match = match & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
        given = budgets.select(*[F.col(c).alias(f"_b_{c}") for c in group], F.col("_up").alias("_b_up"), "_budget")
        joined = below.join(given, match).select(*below.columns, "_budget")
        shares = cut_lineage(joined.groupBy(*group, "_up").applyInPandas(share, told))
        budgets = keyed(shares).select(*group, F.col("_pos").alias("_up"), F.col("weight").alias("_budget"))
    match = F.col("_pos") == F.col("_b_pos")
    for c in names:
        match = match & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    given = shares.select(*[F.col(c).alias(f"_b_{c}") for c in names], F.col("_pos").alias("_b_pos"), "weight")
    return placed.join(given, match).select(*options.columns, "weight")


def exact_selection(items: DataFrame, value: str, weight: str, key: str, cap: float, by: Sequence[str] = (),
                    unit: float = 1.0) -> DataFrame:
    """``items`` with ``selected``: a choice of the largest total value within ``cap``, per group.

    Weights are multiples of ``unit`` and not negative, so work grows with cap / unit. Items above the cap
    or without value or weight are not selected.
    """
    require_columns(items, [value, weight, key, *by])
    steps = int(np.floor(cap / unit + 1e-9))
    w = F.round(F.col(weight) / unit).cast("bigint")
    off = F.abs(w * unit - F.col(weight)) > 1e-9 * F.greatest(F.lit(1.0), F.abs(F.col(weight)))
    checked = F.when(off | (F.col(weight) < 0), F.raise_error(F.lit(f"weights must be multiples of {unit} and not negative"))).otherwise(w)
    can = items.filter(F.col(value).isNotNull() & F.col(weight).isNotNull() & (F.col(weight) <= cap) & (F.col(value) > 0))
    empty = F.array_repeat(F.lit(None).cast("double"), F.greatest(F.col("_w") - 1, F.lit(0)).cast("int"))
    taken = F.concat(F.array(F.lit(0.0)), empty, F.array(F.col(value).cast("double")))
    options = can.select(*by, F.col(key).alias("item"), checked.alias("_w"), F.col(value)).select(
        *by, "item", F.when(F.col("_w") == 0, F.array(F.col(value).cast("double"))).otherwise(taken).alias("values"), F.col("_w"))
    chosen = allocate(options, by, steps).filter((F.col("weight") > 0) | (F.col("_w") == 0))
    match = F.col(key).eqNullSafe(F.col("_item"))
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    picked = chosen.select(F.col("item").alias("_item"), *[F.col(c).alias(f"_s_{c}") for c in by], F.lit(True).alias("_is"))
    return items.join(picked, match, "left").select(*items.columns, F.coalesce("_is", F.lit(False)).alias("selected"))
