"""Snapshot retention, archive and reload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.files import archive
from ..sources.tables import merged_parquet

# Fixed values.
RETENTION_WORD = "reporting"
DAY_SECONDS = 86_400
RETENTION_DAYS = 5


def retention(manifest: DataFrame, now: str, name: str = "DBSnapshotIdentifier",
              created: str = "SnapshotCreateTime", word: str = RETENTION_WORD,
              days: int = RETENTION_DAYS) -> DataFrame:
    """(name, age_days, action) of the snapshots whose name holds the word.

    A snapshot of exactly the retention age is deleted.
    """
    age = F.timestamp_diff("SECOND", F.col(created), F.lit(now).cast("timestamp_ntz"))
    return manifest.where(F.col(name).contains(word)).select(
        F.col(name),
        F.floor(age / DAY_SECONDS).alias("age_days"),
        F.when(age >= days * DAY_SECONDS, "delete").otherwise("keep").alias("action"),
    )


def archive_and_reload(
    spark: SparkSession, current: str, archive_path: str, day: str, fresh: DataFrame
) -> DataFrame:
    """Copies the current files to the archive, then replaces them by the fresh ones."""
    archive(spark.read.parquet(current), archive_path, day)
    fresh.write.mode("overwrite").parquet(current)
    return merged_parquet(spark, current)
