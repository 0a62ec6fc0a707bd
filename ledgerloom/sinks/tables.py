"""Warehouse tables, storage layouts and several tables from one frame."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def portfolio_table(gateway: str, country: str) -> str:
    """Target table of a gateway's sales portfolio."""
    return f"gateway_cust_portfolio_{gateway}_{country}"


def append_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Appends to a saved table, which is made at `path` if it does not exist."""
    writer = df.write.mode("append")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def append_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    df.write.jdbc(url, table, mode="append", properties=properties)


def write_all(prepared: DataFrame, outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
              write: Callable[[DataFrame, str], None]) -> None:
    """Several outputs of one prepared frame, which is computed once.

    The frame should be the smallest common one, such as a rollup that all outputs
    are built on; what memory cannot hold goes to disk.
    """
    prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, derive in outputs.items():
            write(derive(prepared), name)
    finally:
        prepared.unpersist()


def clustered_parquet(df: DataFrame, path: str, distribute_by: str, sort_by: str) -> None:
    """Rows distributed by one column and sorted by another, zstd compressed.

    The sort gives row groups with narrow value ranges, so filters on the sort
    column skip most of them.
    """
    (
        df.repartition(distribute_by)
        .sortWithinPartitions(sort_by)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .parquet(path)
    )


def bucketed_table(df: DataFrame, table: str, buckets: int, distribute_by: str, sort_by: str) -> None:
    """As a table whose joins and groupings on the distribution column need no shuffle."""
    (
        df.repartition(buckets, distribute_by)
        .write.bucketBy(buckets, distribute_by)
        .sortBy(sort_by)
        .option("compression", "zstd")
        .format("parquet")
        .saveAsTable(table)
    )
