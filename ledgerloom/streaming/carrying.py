"""Values carried forward in a stream whose devices may send any share of a micro-batch.

Spark hands all rows of a key in a micro-batch to one call of one task, and Python holds what that
call returns. Here a micro-batch is filled by slices of (device, order) in place of that, so a
device spans many tasks. What the devices hold is kept in files beside the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.slices import carry_forward
from ..session import make_dir, remove_dir
from .runs import in_batches

# Fixed value: every so many batches the values of all devices are written, else those of the batch's.
WHOLE_EVERY = 20


def _held(spark: SparkSession, folder: str, schema: T.StructType, device: str, values: Sequence[str], number: int) -> DataFrame:
    """What each device holds before batch `number`: (device, values) of its newest batch, from the last whole one on."""
    first = max(number - 1, 0) // WHOLE_EVERY * WHOLE_EVERY
    parts = [
        spark.read.schema(schema).parquet(f"{folder}/{n}").withColumn("_batch", F.lit(n)) for n in range(first, number)
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    newest = reduce(DataFrame.union, parts).groupBy(device).agg(F.max_by(F.struct(*values), "_batch").alias("_values"))
    return newest.select(device, *[F.col(f"_values.{v}").alias(v) for v in values])


def carry_in_batches(
    messages: DataFrame, out: str, checkpoint: str, device: str, order: Sequence[str], values: Sequence[str],
    every: str | None = None,
) -> StreamingQuery:
    """Writes messages with absent values filled from the same device's earlier ones, each
    micro-batch below `cycle=<number>` of `out`; a batch that runs again replaces its own.

    Messages are taken by `order` (nulls first) within a micro-batch, and batch after batch. What a
    device held before comes into its batch as a first row, so nothing is looked up per message. No
    task holds a device: rows are dealt by ranges of (device, order) and sorted by Spark. A batch
    writes one row of values per device of its own, and now and then those of all devices, from which
    the next batch reads on; older ones are removed, as are the slices of a batch once it is written.
    """
    spark, values, order = messages.sparkSession, list(values), list(order)
    kept = T.StructType([T.StructField(c, messages.schema[c].dataType) for c in [device, *values]])
    folder, slices = f"{checkpoint}/held", f"{checkpoint}/slices"

    def write(batch: DataFrame, number: int) -> None:
        held = _held(batch.sparkSession, folder, kept, device, values, number)
        own = batch.select(F.col(device).alias("_device")).distinct()
        before = held.join(own, F.col(device).eqNullSafe(F.col("_device")), "left_semi")
        new = batch.withColumn("_new", F.lit(True))

        def after(earlier: DataFrame) -> DataFrame:
            return new.unionByName(earlier.withColumn("_new", F.lit(False)), allowMissingColumns=True)

        remove_dir(spark, slices)
        filled = carry_forward(after(before), [device], ["_new", *order], values, slices)
        filled.where("_new").select(*messages.columns).write.mode("overwrite").parquet(f"{out}/cycle={number}")
        last = {v: F.max_by(v, F.when(F.col(v).isNotNull(), F.struct("_new", *order))).alias(v) for v in values}
        now = after(before if number % WHOLE_EVERY else held).groupBy(device).agg(*last.values())
        now.write.mode("overwrite").parquet(f"{folder}/{number}")
        remove_dir(spark, slices)
        if number % WHOLE_EVERY == 1:
            for n in range(max(number - 1 - WHOLE_EVERY, 0), number - 1):
                remove_dir(spark, f"{folder}/{n}")

    make_dir(spark, out)
    return in_batches(messages, write, checkpoint, every)


def read_carried(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """What `carry_in_batches` has written of messages of `schema`."""
    whole = T.StructType([*schema.fields, T.StructField("cycle", T.LongType())])
    return spark.read.schema(whole).parquet(out).select(*schema.names)
