"""Starting streams and writing their tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None,
    name_filter: str = "*.parquet",
) -> DataFrame:
    """Parquet files of a folder as they arrive. The rate limit bounds a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name_filter)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def to_table(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Appends a stream to parquet. With `every` it runs on in cycles, such as
    `10 minutes`; without, it processes what has arrived and ends."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def to_topic(stream: DataFrame, servers: str, topic: str, key: str, checkpoint: str) -> StreamingQuery:
    """Every row as a JSON message, keyed by device so that the load spreads."""
    return (
        stream.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB and checkpoint its changes, not all of it."""
    kept = {name: spark.conf.get(name, None) for name in ROCKSDB}
    for name, value in ROCKSDB.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in kept.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def in_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Hands every micro-batch to a function, which must give the same result when a
    batch is run again. With `every` it runs on in cycles; without, it ends by itself."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def in_cycles(
    stream: DataFrame, out: str, checkpoint: str, every: str, enough: Callable[[list[dict]], bool],
    partition_by: Sequence[str] = (),
) -> list[dict]:
    """Runs in fixed cycles, each writing what has come since the last below `cycle=<number>`, a
    file per folder; a cycle without rows writes nothing, one that runs again replaces its own.

    `enough` is asked after every cycle that had rows, with the progress of all of them. When it
    says so, the cycle that is under way is finished and the stream stops; started again, it goes
    on with the next number.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        if not batch.isEmpty():
            gathered = batch.repartition(*partition_by) if partition_by else batch.coalesce(1)
            gathered.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{out}/cycle={number}")
        batch.unpersist()

    query = in_batches(stream, write, checkpoint, every)
    cycles: dict[int, dict] = {}
    try:
        while query.isActive:
            cycles |= {p["batchId"]: p for p in query.recentProgress if p["numInputRows"]}
            if cycles and enough([cycles[n] for n in sorted(cycles)]):
                query.processAllAvailable()
                break
            query.awaitTermination(0.2)
    finally:
        query.stop()
    finish(query)
    cycles |= {p["batchId"]: p for p in query.recentProgress if p["numInputRows"]}
    return [cycles[n] for n in sorted(cycles)]


def finish(query: StreamingQuery) -> None:
    """Waits for a stream that ends by itself; a failure is raised here."""
    query.awaitTermination()
    failure = query.exception()
    if failure is not None:
        raise failure
