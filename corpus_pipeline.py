"""From raw documents to packed training sequences.

Documents that the quality rules reject go, then exact copies, then near duplicates but for one
of each group; the rest is mixed by source and packed. Every stage works on all that the stage
before has kept, and reads it from storage, so a lost executor never repeats earlier stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepoint.llm.exact import drop_copies
from tidepoint.llm.minhash import drop_near_copies
from tidepoint.llm.mixing import mixed_documents
from tidepoint.llm.packing import packed_pieces
from tidepoint.llm.registry import importable
from tidepoint.llm.rules import keep_good
from tidepoint.session import scratch_path

# The mixture reads every document; none more than twice.
MAX_REPEATS = 2.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule of the current policy."""
    importable(spark)
    return keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are alike on shingles of five words, the one with the smallest id."""
    importable(spark)
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for."""
    return mixed_documents(docs, max_repeats=MAX_REPEATS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens."""
    importable(spark)
    return packed_pieces(docs)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing", mixing),
    ("packing", packing),
]

# Tokens and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        folder = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
