"""CSV and parquet outputs, dated folders, archives."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def csv_with_header(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def csv_without_header(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """The chosen columns in the given order."""
    df.select(*columns).write.option("header", False).csv(path)


def with_date_parts(df: DataFrame, ts: Column | str) -> DataFrame:
    """Adds the folder columns `year`, `month`, `day` as text with leading zeros."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return df.withColumns(
        {
            "year": F.date_format(ts, "yyyy"),
            "month": F.date_format(ts, "MM"),
            "day": F.date_format(ts, "dd"),
        }
    )


def dated_parquet(df: DataFrame, path: str, ts: Column | str) -> None:
    """Parquet below `year=/month=/day=`, which later filters on these prune.

    Each day's rows are gathered into a few tasks first, so that a day gets a few
    files and not one per task; AQE splits days that are large.
    """
    dated = with_date_parts(df, ts)
    dated.hint("rebalance", "year", "month", "day").write.partitionBy("year", "month", "day").parquet(path)


def range_named_path(folder: str, name: str, start: str, end: str) -> str:
    """A path that states the days covered; the suffix keeps reruns apart."""
    return f"{folder}/{name}({start}_{end}){uuid.uuid4()}.csv"


def archive(df: DataFrame, path: str, day: str) -> None:
    """A copy of the current table below its archive day. A rerun replaces the day."""
    dated = df.withColumn("archive_date", F.lit(day).cast("date"))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("archive_date").parquet(path)
