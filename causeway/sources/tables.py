"""Reading tables: Parquet by name, CSV with types and null tokens, media fact tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from causeway.session import require_columns

NULL_TOKENS = ("", "NA", "N/A")
AD_COLUMNS = ("Date", "channel", "Impressions", "Spend", "Sales")


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """CSV with a header, given column types and any number of null tokens.

    The reader knows one null token only, so columns arrive as text, tokens become null and
    the cast raises on text that is not of the stated type.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.schema(text).option("header", True).csv(path)
    return raw.select(*[
        F.when(~F.col(f.name).isin(*null_tokens), F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema
    ])


def ad_facts(df: DataFrame) -> DataFrame:
    """Check a media fact table and bring it to (Date, channel, Impressions, Spend, Sales)."""
    require_columns(df, AD_COLUMNS)
    return df.select(
        F.col("Date").cast("date").alias("Date"), F.col("channel").cast("string").alias("channel"),
        *[F.col(c).cast("double").alias(c) for c in AD_COLUMNS[2:]],
    )
