"""A job done part by part, for jobs whose shuffles would together outgrow the disks.

Spark keeps all shuffle files of a job until it ends. Done in parts, one after the other, only those
of one part are on disk, and what has been made is stored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import ColumnOrName, column
from ..session import scratch_dir

# Bytes of input files in a part, and the setting that has shuffle files removed once
# the job that wrote them has ended.
PART_BYTES = 128_000_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def parts_for(df: DataFrame, part_bytes: int | None = None) -> int:
    """In how many parts a frame made of files is to be taken; 1 where a size is not known."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return 1 if size >= 1 << 62 else max(1, -(-size // (part_bytes or PART_BYTES)))


def is_part(key: ColumnOrName, part: int, parts: int) -> Column:
    """Whether a row belongs to a part, by its key; a null key belongs to one, too."""
    return F.pmod(F.xxhash64(column(key)), F.lit(parts)) == part


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs inside remove their shuffle files when they end."""
    kept = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if kept is None else spark.conf.set(CLEANUP, kept)


def in_parts(spark: SparkSession, parts: int, made: Callable[[int], DataFrame], label: str) -> DataFrame:
    """The rows of all parts, each made and stored in the shared folder before the next is begun."""
    path = scratch_dir(spark, label)
    with shuffles_removed(spark):
        for part in range(parts):
            df = made(part)
            df.write.option("compression", "zstd").parquet(f"{path}/{part}")
    return spark.read.schema(df.schema).parquet(*[f"{path}/{part}" for part in range(parts)])
