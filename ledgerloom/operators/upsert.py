"""Put by key, and update of one column by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookups import drop_matches, first_per_key


def upsert(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], newest_first: Sequence[Column | str]
) -> DataFrame:
    """`current` with the newest change of every key put in.

    The table itself is only filtered by an anti join: where the changes are small
    it is neither shuffled nor sorted. `changes` may hold order columns that the
    table lacks.
    """
    latest = first_per_key(changes, keys, newest_first).select(*current.columns)
    kept = drop_matches(current, latest.select(*keys), list(keys))
    return kept.unionByName(latest)


def update_column(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], column: str
) -> DataFrame:
    """Sets one column where a key has a change; other rows stay as they are.

    `changes` must hold a key once.
    """
    new = changes.select(*keys, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    value = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))
    return current.join(new, list(keys), "left").withColumn(column, value).select(*current.columns)
