"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

1. language ID drops documents without a letter or a clear language;
2. SimHash near-dedup keeps one document of each group of linked fingerprints;
3. substring dedup cuts passages of 50 words or more that an earlier document has, n_chars follows;
4. decontamination drops documents with an occurrence of 10 consecutive benchmark words;
5. packing places what is left, tokenized, into sequences of 1024 ids, written in order with their ids.

Stages 1 to 4 return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from causeway.llm.common import stored
from causeway.llm.decontam import keep_clean
from causeway.llm.langid import keep_identified
from causeway.llm.packing import pack
from causeway.llm.simhash import keep_one
from causeway.llm.substring import remove_repeats
from causeway.sources.tables import load


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, distance=2, shingle=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that lose nothing stay as they are; a document that loses all its words stays with an empty text."""
    found = remove_repeats(docs, 50)
    cut = F.col("n_removed") > 0
    changed = {"text": F.when(cut, F.col("kept_text")).otherwise(F.col("text")),
               "n_chars": F.when(cut, F.length("kept_text")).otherwise(F.col("n_chars")).cast("bigint")}
    return found.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, load(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, 1024, 2, in_order=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The stages are models, fingerprints and tokens that SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
