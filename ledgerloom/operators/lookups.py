"""Joins: matches kept or dropped, first and last per key, parents.

No side is broadcast by hint. Spark does so by itself when a side's size is below
`spark.sql.autoBroadcastJoinThreshold`, and adaptive execution splits the hot keys
of the joins that are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_matches(df: DataFrame, other: DataFrame, condition: Column | str | list) -> DataFrame:
    """Rows of `df` without a match. Stated as an anti join, since Spark does not
    derive one from a left join with a NULL test."""
    return df.join(other, condition, "left_anti")


def keep_matches(df: DataFrame, other: DataFrame, condition: Column | str | list) -> DataFrame:
    """Rows of `df` with at least one match; never multiplies rows."""
    return df.join(other, condition, "left_semi")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first by `order`, which must leave no ties.

    Spark keeps one row per key and task before it shuffles (window group limit),
    so a key that holds much of the data is no hot spot.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_value_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """key -> value of its last row; combined before the shuffle."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def with_parent(
    df: DataFrame, key: str, parent: str, code: str, title: str, root_mark: str = "-"
) -> DataFrame:
    """Code and title of a row's parent, or its own where it is a root.

    Adds `root_code` and `root_title`. A parent key without a row also leaves the
    row's own values.
    """
    up = df.select(
        F.col(key).alias("_up_key"), F.col(code).alias("_up_code"), F.col(title).alias("_up_title")
    )
    is_child = F.col(parent) != root_mark
    return (
        df.join(up, is_child & (F.col(parent) == F.col("_up_key")), "left")
        .withColumns(
            {
                "root_code": F.coalesce("_up_code", code),
                "root_title": F.coalesce("_up_title", title),
            }
        )
        .drop("_up_key", "_up_code", "_up_title")
    )
