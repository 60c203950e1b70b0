"""Session helpers: shared scratch folder, lineage cuts, schema checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates.

    Taken from ``spark.checkpoint.dir``. A folder of our own is made only on a
    single-machine master where that setting is missing.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="causeway-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/causeway/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate that no frame reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and freezes row placement."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = shared_dir(df.sparkSession)
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def keep(df: DataFrame) -> DataFrame:
    """Cache a bucketed or result-sized frame that several passes read; spills to disk."""
    return df if df.is_cached else df.persist()


def require_columns(df: DataFrame, columns) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
