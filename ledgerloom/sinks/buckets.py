"""Tables kept in buckets of their keys' hash, so that a put rewrites the buckets it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookups import drop_matches, first_per_key
from ..operators.slices import stored

BUCKET = "_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int, touched_only: bool = False) -> None:
    """One folder per bucket. A bucket's rows are gathered before the write, so it gets a few
    files; adaptive execution splits large ones. `touched_only` leaves other buckets as they are."""
    placed = df.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET)
    mode = "dynamic" if touched_only else "static"
    placed.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)


def put_buckets(
    spark: SparkSession, path: str, changes: DataFrame, schema: T.StructType, keys: Sequence[str],
    newest_first: Sequence[Column | str], buckets: int,
) -> None:
    """Puts the newest change of each key into the table at `path`.

    The changes are ranked once and stored. Only the buckets that hold a changed key are read and
    written; their numbers, at most `buckets`, come to the driver. The rewritten folders are put
    in place when all are written, and a put that is run again gives the same table.
    """
    newest = first_per_key(changes, keys, newest_first).select(*schema.names)
    latest = stored(newest.withColumn(BUCKET, bucket_of(keys, buckets)), "changes")
    numbers = [r[0] for r in latest.select(BUCKET).distinct().collect()]
    touched = read_buckets(spark, path, schema).where(F.col(BUCKET).isin(numbers))
    kept = drop_matches(touched, latest.select(*keys), list(keys))
    write_buckets(kept.unionByName(latest).drop(BUCKET), path, keys, buckets, touched_only=True)
