"""Helpers that several operators share.

Everywhere: a row whose id is null names no document and is left out; a null text counts as
empty; columns beside the id and the text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar, copy_context

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import remove_dir, scratch_dir

# The folders that the settled() call around has to remove.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def texts_of(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) with the defaults that every operator shares."""
    return documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    ).where("doc_id IS NOT NULL")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written below the shared folder and read back: its rows are computed once,
    and a lost executor costs a file read, not the work before it."""
    spark: SparkSession = df.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    if (passing := _passing.get()) is not None:
        passing.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """The frame that `make` returns, stored. What `make` stored on the way is removed then, or
    when it fails, so no other frame that it made can be read any more."""
    passing: list[str] = []
    inside = copy_context()
    inside.run(_passing.set, passing)
    try:
        return stored(inside.run(make), label)
    finally:
        for path in passing:
            remove_dir(spark, path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(*columns: Column | str) -> Column:
    """A non-negative hash."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node long, component long): the smallest node that links reach, for every node of
    `edges` (a long, b long).

    Alternating large and small stars: each round hangs the larger neighbours of a node on
    its smallest one, then the smaller ones. The paths shorten by a constant factor, so the
    rounds grow with the logarithm of the longest path. The work of a round is a minimum per
    node, combined before the shuffle, and a join whose hot nodes adaptive execution splits.
    A node without an edge to another node is not in the result.
    """
    links = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links"
    )

    def total(df: DataFrame):
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1000003).alias("s")).first()
        return row["n"], row["s"]

    state = total(links)
    for _ in range(rounds):
        if state[0] == 0:
            break
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a > b").distinct()
        )
        links = stored(small, "links")
        now = total(links)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def tokenizer(name: str) -> str:
    """The path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)
