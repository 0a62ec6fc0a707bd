"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns of `docs`, extra ones included. Rows without an id leave
in the first stage. Rows that repeat an id and a text stay or go together.

A stage that drops rows stores the ids of those that stay when it is called, and removes what
its operator stored on the way: the returned frame reads `docs` and these ids alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.queries.base import table

from . import exact_copies as exact
from . import near_copies as near
from .common import settled, tokenizer
from .packing import pack
from .passages import remove_passages
from .quality import classify_quality


def _kept(spark: SparkSession, docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    kept = settled(spark, lambda: operator(docs).where("kept").select("doc_id").distinct(), "kept")
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose perplexity is beyond their language's threshold."""
    labels = table(spark, sf_dir, "labels")
    kept = settled(
        spark, lambda: classify_quality(docs, labels).where("kept").select("doc_id", F.col("mark").alias("_mark")).distinct(), "kept"
    )
    marked = docs.withColumn("_mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    return marked.join(kept, ["doc_id", "_mark"], "left_semi").select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one that the operator keeps."""
    return _kept(spark, docs, exact.exact_copies)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies."""
    return _kept(spark, docs, near.near_copies)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier document holds too; n_chars is counted anew."""
    left = remove_passages(docs).select("doc_id", F.col("kept_text").alias("text"))
    out = docs.drop("text").dropDuplicates().join(left, "doc_id")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return pack(docs, tokenizer("byte_bpe_50k.json"))
