"""Ordered limits and pages.

The first n rows are those up to the n-th key of the order, and a page those between two keys.
Such a key is found from counts per range of the order, on the order's columns alone; then the
frame is filtered by it, which sorts and copies nothing and reaches the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .slices import running_position

# A range of at most so many rows is ordered in one task, a larger one is counted by ranges again.
BORDER_ROWS = 100_000


def _ranges(keys: DataFrame) -> list[Row]:
    """Count, lowest and highest key of each range of the order: one row per shuffle partition."""
    parts = max(2, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.struct(*keys.columns)
    counted = keys.repartitionByRange(parts, *keys.columns).groupBy(F.spark_partition_id().alias("part")).agg(
        F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
    )
    return sorted(counted.collect(), key=lambda r: r.part)


def _bounded(df: DataFrame, keys: DataFrame, low: Row | None, high: Row | None) -> DataFrame:
    """The rows from one key to another, both included; nulls come first."""

    def literal(row: Row) -> Column:
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, keys.schema, strict=True)])

    key, first, kind = F.struct(*keys.columns), F.col(keys.columns[0]), keys.schema[0].dataType
    # The first column is compared once more by itself, as only that reaches the scan.
    if low is not None:
        df = df.where(key >= literal(low))
        df = df if low[0] is None else df.where(first >= F.lit(low[0]).cast(kind))
    if high is not None:
        df = df.where(key <= literal(high))
        df = df.where(first.isNull() if high[0] is None else first.isNull() | (first <= F.lit(high[0]).cast(kind)))
    return df


def keys_at(df: DataFrame, order: Sequence[str], ranks: Sequence[int]) -> list[Row | None]:
    """The keys at 1-based places of the order, None beyond its end.

    Each round counts ranges and goes on inside the one that holds the place, so that the rows
    looked at shrink by the number of shuffle partitions. The jobs run when this is called.
    """
    keys = df.select(*order)
    whole = _ranges(keys)
    out: list[Row | None] = []
    for rank in ranks:
        inside, found, left = keys, whole, rank
        while True:
            for part in found:
                if left <= part.n:
                    break
                left -= part.n
            else:
                out.append(None)
                break
            inside = _bounded(inside, keys, part.low, part.high)
            if part.low == part.high:
                out.append(part.low)
                break
            if part.n <= BORDER_ROWS or len(found) == 1:
                out.append(inside.orderBy(*order).offset(left - 1).limit(1).first())
                break
            found = _ranges(inside)
    return out


def ordered_limit(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of an order without ties, so that the result is repeatable.

    Rows that tie with the n-th are all kept.
    """
    if n < 1:
        return df.limit(0)
    return _bounded(df, df.select(*order), None, keys_at(df, order, [n])[0])


def page_slice(df: DataFrame, order: Sequence[str], start: int, size: int) -> DataFrame:
    """Rows start..start+size-1 of the order, counted from 1.

    The rows are picked where they lie, so no task gathers the pages before and none is copied.
    Rows that tie with the first or last of the page are on it.
    """
    first, last = max(start, 1), start + size - 1
    if last < first:
        return df.limit(0)
    low, high = keys_at(df, order, [first, last])
    return df.limit(0) if low is None else _bounded(df, df.select(*order), low, high)


def paged(df: DataFrame, order: Sequence[str], size: int, name: str = "page") -> DataFrame:
    """Every row with its 1-based page number."""
    numbered = running_position(df, [], order, "_position")
    page = F.floor((F.col("_position") - 1) / F.lit(size)) + 1
    return numbered.withColumn(name, page.cast("bigint")).drop("_position")


def first_scalar(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """One row, one column: the value in the first row, for use as a scalar subquery."""
    return df.agg(F.min_by(column, F.struct(*order)).alias(column))
