"""Readings in time bins and the change between neighbouring bins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import bin_end


def last_per_bin(
    df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], values: Sequence[str],
    minutes: int = 10,
) -> DataFrame:
    """Last value of every (key, bin); combined before the shuffle, so a device that
    sends much of the data is no hot spot."""
    return df.groupBy(*keys, bin_end(ts, minutes).alias("bin")).agg(
        *[F.max_by(v, F.struct(*order)).alias(v) for v in values]
    )


def change_since_previous_bin(
    bins: DataFrame, keys: Sequence[str], values: Sequence[str], minutes: int = 10, digits: int = 2
) -> DataFrame:
    """Adds `<value>_change`: the difference to the bin just before, 0.00 if there is none.

    `bins` holds one row per (key, bin). Each is joined with the one before it, so the rows are
    spread by key and bin: neither a device with many bins nor a frame without keys is gathered
    in one task.
    """
    before = bins.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        (F.col("bin") + F.make_dt_interval(mins=F.lit(minutes))).alias("_bin"),
        *[F.col(v).alias(f"_before_{v}") for v in values],
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = bins.join(before, reduce(and_, same, F.col("bin") == F.col("_bin")), "left")
    return joined.select(
        *bins.columns,
        *[
            F.when(F.col("_bin").isNotNull(), F.round(F.col(v) - F.col(f"_before_{v}"), digits)).otherwise(F.lit(0.0)).alias(f"{v}_change")
            for v in values
        ],
    )


def previous_bin_by_join(
    bins: DataFrame, keys: Sequence[str], value: str, minutes: int = 10
) -> DataFrame:
    """Adds `previous_<value>`, found by an equi-join on (key, bin)."""
    before = bins.select(
        *keys,
        (F.col("bin") + F.make_dt_interval(mins=F.lit(minutes))).alias("bin"),
        F.col(value).alias(f"previous_{value}"),
    )
    return bins.join(before, [*keys, "bin"], "left")
