"""The corpus pipeline: filters and deduplicates `documents`, then packs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import stages
from ledgerloom.llm.common import settled
from ledgerloom.queries.base import table

STAGES = [
    ("quality classifier", stages.quality),
    ("exact dedup", stages.exact_copies),
    ("near dedup", stages.near_copies),
    ("repeated passages", stages.passages),
    ("packing", stages.packing),
]

# A language model's perplexity and tokenizers are beyond SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. Each stage is written as Parquet and read back for the next; what it
    read and stored on the way is removed once it is written."""

    def after(stages: int) -> DataFrame:
        if not stages:
            return table(spark, sf_dir, "documents")
        name, stage = STAGES[stages - 1]
        return settled(spark, lambda: stage(spark, after(stages - 1), sf_dir), name.replace(" ", "-"))

    return STAGES[-1][1](spark, after(len(STAGES) - 1), sf_dir)
