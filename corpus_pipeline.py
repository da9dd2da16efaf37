"""Training-data pipeline over ``documents``: five stages, each written and read again by the next.

Stages 1 to 4 return the columns of ``documents``; the last returns packed pieces.
The near-duplicate stage uses three-word shingles and at most two differing bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontaminate, line_dedup, packing, quality, simhash
from ledgerline.llm.common import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose perplexity the classifier rejects."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated multi-line chunks out of the texts (``n_chars`` follows the text)."""
    return line_dedup.dedup_lines(docs, length_col="n_chars")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest document of every near-duplicate component."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents, placed in sequences of 2048 ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("simhash", simhash_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: Perplexities, bit signatures and token ids have no DuckDB form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
