"""Aggregates of the ticket, alarm and image reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import ColumnOrName, column


def net_box_office(amount: ColumnOrName, gst: ColumnOrName, tax: ColumnOrName,
                   surcharge: ColumnOrName, surcharge_gst: ColumnOrName) -> Column:
    """Net sales of one ticket; NULL if any term is, so a sum leaves that row out."""
    return column(amount) - column(gst) - column(tax) + column(surcharge) - column(surcharge_gst)


def rounded_sum(c: ColumnOrName, digits: int = 2) -> Column:
    return F.round(F.sum(column(c)), digits)


def distinct_in_group(name: str, group_keys: Sequence[str]) -> Column:
    """COUNT(DISTINCT name) for a grouping by `group_keys`.

    A grouping key has one value per group, so its count is 1, or 0 where it is NULL,
    and needs no distinct pass. The maximum of a number keeps the grouping a hash
    aggregate, which the first value of a text would not.
    """
    if name in group_keys:
        return F.max(F.when(F.col(name).isNotNull(), F.lit(1)).otherwise(F.lit(0))).cast("bigint")
    return F.count_distinct(name)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Real division; NULL where the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def children_per_key(df: DataFrame, key: str, name: str = "children") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """One row with the number of rows, for use as a scalar subquery."""
    return df.agg(F.count("*").alias(name))


def daily_alarms(
    calls: DataFrame, name: str, ts: str, amount: str, limit: int = 10
) -> DataFrame:
    """(name, day, total) for every name whose daily total reaches the limit."""
    return (
        calls.groupBy(name, F.to_date(ts).alias("day"))
        .agg(F.sum(amount).alias("total"))
        .where(F.col("total") >= limit)
    )


def hold_out_months(df: DataFrame, day: str, months: int = 6) -> DataFrame:
    """Rows at or before (latest day - months); the cut is a scalar subquery, so no
    value passes through the driver."""
    cut = df.select(F.add_months(F.max(day), -months).alias("cut"))
    return df.where(F.col(day) <= cut.scalar())
