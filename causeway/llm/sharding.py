"""Reproducible global shuffle into shards: a Feistel permutation over global row numbers.

Rows get gapless numbers in a total order. A Feistel network over Z_a x Z_b (a*b just above the
row count n) permutes [0, n): positions from n on are walked along their cycle until they are
below n. Shard and slot follow from the position by one division, so any row can be found again
without a lookup, and ``original_row`` inverts the shuffle.

Everything is DataFrame functions. Only per-partition row counts reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from causeway.llm.common import stored
from causeway.session import cut_lineage, require_columns

ROUNDS = 6


def domain(n: int) -> tuple[int, int]:
    """(a, b) with a*b >= n and fewer than a positions in excess."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _mix(value: Column, key: int, modulus: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit(key).cast("bigint")), F.lit(modulus).cast("bigint"))


def _step(df: DataFrame, name: str, a: int, b: int, seed: int, moved: Column, rounds: Sequence[int], sign: int) -> DataFrame:
    """One pass of the network over column ``name`` where ``moved`` holds, in the given order of rounds."""
    df = df.withColumns({"_go": moved, "_l": F.expr(f"{name} div {b}"), "_r": F.pmod(F.col(name), F.lit(b))})
    for k in rounds:
        if k % 2 == 0:
            df = df.withColumn("_l", F.pmod(F.col("_l") + F.lit(sign) * _mix(F.col("_r"), seed * 64 + k, a), F.lit(a)))
        else:
            df = df.withColumn("_r", F.pmod(F.col("_r") + F.lit(sign) * _mix(F.col("_l"), seed * 64 + k, b), F.lit(b)))
    return df.withColumn(name, F.when(F.col("_go"), F.col("_l") * F.lit(b) + F.col("_r")).otherwise(F.col(name))).drop(
        "_go", "_l", "_r")


def longest_walk(spark: SparkSession, n: int, seed: int) -> int:
    """Steps that the longest cycle walk needs, found on the excess positions (fewer than sqrt(n) + 1 rows)."""
    a, b = domain(n)
    excess = spark.range(n, a * b).select(F.col("id").alias("x"))
    entered = _step(excess.withColumn("e", F.col("x")), "x", a, b, seed, F.lit(True), range(ROUNDS)[::-1], -1)
    out = cut_lineage(entered.filter(F.col("x") < n).select(F.col("e").alias("x")))
    steps = 0
    while not out.isEmpty():
        out = cut_lineage(_step(out, "x", a, b, seed, F.lit(True), range(ROUNDS), 1).filter(F.col("x") >= n))
        steps += 1
    return steps


def permute(df: DataFrame, name: str, n: int, seed: int = 0, inverse: bool = False) -> DataFrame:
    """Replace row numbers 0..n-1 in ``name`` by their place in the shuffle (or back)."""
    if n == 0:
        return df
    a, b = domain(n)
    order, sign = (range(ROUNDS)[::-1], -1) if inverse else (range(ROUNDS), 1)
    walk = longest_walk(df.sparkSession, n, seed)
    df = df.withColumn(name, F.col(name).cast("bigint"))
    df = _step(df, name, a, b, seed, F.lit(True), order, sign)
    for _ in range(walk):
        df = _step(df, name, a, b, seed, F.col(name) >= n, order, sign)
    return df


def numbered(df: DataFrame, order: Sequence[str], name: str) -> tuple[DataFrame, int]:
    """Gapless row numbers from 0 in the order of ``order`` (nulls first), and the row count.

    Range partitioning spreads a hot key over tasks because the row's own scan position breaks
    ties; rows equal in every ordering column are interchangeable. The placement is frozen by a
    written table before partition sizes are counted; later steps read the columns they need from it.
    """
    require_columns(df, order)
    keys = [F.col(c).asc_nulls_first() for c in order]
    placed = df.withColumn("_scan", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*keys, F.col("_scan").asc()).sortWithinPartitions(*keys, F.col("_scan").asc())
    placed = stored(placed.drop("_scan").withColumns({
        "_block": F.spark_partition_id(),
        "_index": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    }), "numbered")
    sizes = {r["_block"]: r["n"] for r in placed.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for block in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(block, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts or [0]]), F.col("_block") + 1)
    return placed.withColumn(name, start + F.col("_index")).drop("_block", "_index"), total


def shard_rows(df: DataFrame, order: Sequence[str], shards: int, seed: int = 0) -> DataFrame:
    """Add ``shard`` and ``slot``: row counts of shards differ by one at most, slots are gapless from 0.

    ``order`` fixes the row numbers; with the same rows, shard count and seed every run gives the
    same result, and rows that are equal in every ordering column may swap places. Null keys sort
    first, an empty table stays empty. Columns named ``shard`` or ``slot`` are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    rows, n = numbered(df.drop("shard", "slot"), order, "_position")
    out = permute(rows, "_position", n, seed)
    return out.withColumns({
        "shard": F.pmod(F.col("_position"), F.lit(shards)).cast("int"),
        "slot": F.expr(f"_position div {shards}"),
    }).drop("_position")


def shard_documents(documents: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``documents`` with ``shard`` and ``slot``: whole rows, numbered by doc_id and text.

    Rows are ordered by doc_id, size, checksum and a 64-bit hash of the text (null: empty), so rows that
    may swap places hold equal texts. Columns named ``shard`` or ``slot`` are replaced.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    order = {"_size": F.octet_length(text), "_crc32": F.crc32(text.cast("binary")), "_hash": F.xxhash64(text)}
    return shard_rows(documents.withColumns(order), ["doc_id", *order], shards, seed).drop(*order)


def text_facts(sharded: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of sharded rows; size is the UTF-8 length plus one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return sharded.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
                          F.crc32(text.cast("binary")).alias("text_crc32"), "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write whole rows to one folder per shard, in order of slot; a large shard is several files in that order."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
