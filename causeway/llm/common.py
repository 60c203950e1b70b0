"""What several operators share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from causeway.session import scratch_path


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write to the shared folder and read back: compact, columnar, and safe from lost executors."""
    return stored_at(df, scratch_path(df.sparkSession, name), **options)


def stored_at(df: DataFrame, path: str, **options: str) -> DataFrame:
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """A function like ``stored`` whose tables go when the block ends: all that leaves it must be written or checkpointed."""
    paths: list[str] = []

    def store(df: DataFrame, name: str, **options: str) -> DataFrame:
        paths.append(scratch_path(spark, name))
        return stored_at(df, paths[-1], **options)

    try:
        yield store
    finally:
        hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            target = hadoop.Path(path)
            target.getFileSystem(conf).delete(target, True)


def text_slices(batch, size: int, column: str = "text"):
    """Parts of a batch with about ``size`` bytes of text, or one longer text, so few texts are strings at a time."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    part = np.cumsum(sizes) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)] if len(sizes) else []
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(a, b - a)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo; a null doc_id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def least_count(counted: DataFrame, most: int) -> int:
    """Smallest power of two such that at most ``most`` rows have so high an ``n``."""
    sizes = counted.groupBy((F.length(F.bin("n")) - 1).cast("int").alias("bit")).agg(F.count(F.lit(1)).alias("rows")).collect()
    rows, least = 0, 1 << 62
    for r in sorted(sizes, key=lambda r: -r["bit"]):  # at most 63
        rows += r["rows"]
        if rows > most:
            break
        least = 1 << r["bit"]
    return least
