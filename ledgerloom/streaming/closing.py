"""Closing what is open: the last bins of a stream that ends.

A bin closes when the watermark passes its end, and only newer messages move the watermark, so the
last bins of a stream would wait for ever. A closing row moves it: it comes by a folder of its
own, carries a time and nothing else, and is in no result. The bins it closes leave the state, so
a message that comes for them later is late. Newer bins go on as before.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .runs import file_stream, finish, to_table

CLOSING = "_closing"


def marks_closings(messages: DataFrame) -> DataFrame:
    """Messages that say of each row whether it is a closing one."""
    return messages if CLOSING in messages.columns else messages.withColumn(CLOSING, F.lit(False))


def with_closings(messages: DataFrame, ts: str, folder: str) -> DataFrame:
    """The messages and the closing rows of a folder, which is made if it is not there."""
    spark = messages.sparkSession
    only = T.StructType([messages.schema[ts]])
    spark.createDataFrame([], only).write.mode("append").parquet(folder)
    closings = file_stream(spark, folder, only).withColumn(CLOSING, F.lit(True))
    return marks_closings(messages).unionByName(closings, allowMissingColumns=True)


def newest_time(query: StreamingQuery) -> datetime | None:
    """The newest event time of a run that has ended, from its progress."""
    seen = [p["eventTime"]["max"] for p in query.recentProgress if "max" in p["eventTime"]]
    return max((datetime.fromisoformat(t) for t in seen), default=None)


def close_until(spark: SparkSession, schema: T.StructType, ts: str, folder: str, at: datetime) -> None:
    """A closing row; a later time than any message's can be given."""
    moment = at.astimezone(UTC).strftime("%Y-%m-%d %H:%M:%S.%f")
    row = spark.sql(f"SELECT to_timestamp('{moment} UTC', 'yyyy-MM-dd HH:mm:ss.SSSSSS VV') AS t").select(
        F.col("t").cast(schema[ts].dataType).alias(ts)
    )
    row.write.mode("append").parquet(folder)


def land_and_close(
    stream: DataFrame, messages: DataFrame, ts: str, folder: str, path: str, checkpoint: str, width: timedelta,
    delay: timedelta = timedelta(minutes=10), partition_by: tuple[str, ...] = (),
) -> None:
    """Processes what has arrived, then closes the bins of `width` that are open, and ends.

    `stream` is made of `messages` with the closing rows of `folder`. Run again with newer messages
    it goes on; run again without, it changes nothing.
    """
    spark = stream.sparkSession
    query = to_table(stream, path, checkpoint, partition_by)
    finish(query)
    newest = newest_time(query)
    if newest is not None:
        close_until(spark, messages.schema, ts, folder, newest + width + delay + timedelta(seconds=1))
        finish(to_table(stream, path, checkpoint, partition_by))
