"""Numbering and carrying forward inside groups of any size.

A window partitioned by a key puts the whole key into one task. Here the rows are
range-partitioned by (key, order) in place of that, so a large group spans many
slices. Work inside a slice is done where the sort leaves the rows. What a slice
needs from the ones before it fits into one row, because in sorted data only the
first key of a slice can have begun earlier.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir

# The functions that tasks run are shipped by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_HELPERS = ("_slice", "_row", "_key")


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """The frame written to the shared folder and read back, which cuts its lineage. A caller that
    removes it gives its path."""
    spark = df.sparkSession
    path = path or scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _starts(batch: pa.RecordBatch, keys: Sequence[str], before: tuple | None) -> np.ndarray:
    """Whether each row's key differs from the row's before it; nulls are equal, as are NaNs."""
    out = np.zeros(len(batch), bool)
    for name in keys:
        column = batch.column(name)
        if pa.types.is_nested(column.type) or pa.types.is_floating(column.type):
            values = column.to_pylist()
            differ = np.array([repr(x) != repr(y) for x, y in zip(values[1:], values[:-1], strict=True)], bool)
        else:
            one_null = pc.not_equal(pc.is_null(column[1:]), pc.is_null(column[:-1]))
            differ = pc.fill_null(pc.not_equal(column[1:], column[:-1]), False).to_numpy(zero_copy_only=False)
            differ = differ | one_null.to_numpy(zero_copy_only=False)
        out[1:] |= differ
    out[0] = before is None or repr(before) != repr(_key_at(batch, keys, 0))
    return out


def _key_at(batch: pa.RecordBatch, keys: Sequence[str], i: int) -> tuple:
    return tuple(batch.column(name)[i].as_py() for name in keys)


def _in_slice(keys: Sequence[str], fills: Sequence[str]):
    """Adds to sorted rows their place in their key and the last present value of `fills` in it,
    both counted from where the key begins in the slice."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, count, held = None, 0, {}
        for batch in batches:
            if not len(batch):
                continue
            index = np.arange(len(batch))
            begins = _starts(batch, keys, before)
            # Rows before the first start go on from the batch before, as from place -1.
            start = np.maximum.accumulate(np.where(begins, index, -1))
            places = np.where(start < 0, count + index + 1, index - start + 1)
            filled = []
            for name in fills:
                column = batch.column(name)
                first = held.get(name, pa.nulls(1, column.type))
                last = np.maximum.accumulate(np.where(pc.is_valid(column).to_numpy(zero_copy_only=False), index, -1))
                known = last >= np.maximum(start, 0)
                # Position 0 is what the batch before ended with, 1 stands for none.
                both = pa.concat_arrays([first, pa.nulls(1, column.type), column])
                filled.append(both.take(pa.array(np.where(known, last + 2, np.where(start < 0, 0, 1)))))
                held[name] = pa.concat_arrays([filled[-1].slice(len(batch) - 1, 1)])
            before, count = _key_at(batch, keys, len(batch) - 1), int(places[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(places), *filled], [*batch.schema.names, "_here", *[f"_here_{v}" for v in fills]]
            )

    return run


def sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fills: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """Adds `_slice`, `_row` (rising with the order inside a slice) and `_key`; with keys also
    `_here`, a row's place among its key's rows in the slice, and `_here_<v>` for `fills`.

    These are counted where the sort leaves the rows, batch by batch, so there is no second
    shuffle. The result is stored, as range bounds are sampled: a second run could draw
    other bounds, and the passes over the slices must agree.
    """
    laid_out = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumns({"_slice": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    )
    if not keys:
        return stored(laid_out, "slices", path).withColumn("_key", F.lit(0))
    added = [T.StructField("_here", T.LongType()), *(T.StructField(f"_here_{v}", df.schema[v].dataType) for v in fills)]
    marked = laid_out.mapInArrow(_in_slice(list(keys), list(fills)), T.StructType([*laid_out.schema.fields, *added]))
    return stored(marked, "slices", path).withColumn("_key", F.struct(*keys))


def _carried_into(rows: DataFrame, tail: dict, combine: dict) -> DataFrame:
    """What each slice's first key brings along from the slices before.

    `tail` aggregates a slice's rows of its last key, `combine` those results over
    the slices that the key covers. One row per slice, hence small enough to
    broadcast whatever the size of the data.
    """
    edges = rows.groupBy("_slice").agg(
        F.min_by("_key", "_row").alias("_first_key"), F.max_by("_key", "_row").alias("_last_key")
    )
    tails = (
        rows.join(F.broadcast(edges.select("_slice", "_last_key")), "_slice")
        .where(F.col("_key").eqNullSafe(F.col("_last_key")))
        .groupBy("_slice")
        .agg(*[agg.alias(name) for name, agg in tail.items()])
    )
    so_far = Window.partitionBy("_last_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    in_order = Window.orderBy("_slice")
    summed = edges.join(tails, "_slice").withColumns(
        {name: agg.over(so_far) for name, agg in combine.items()}
    )
    continued = F.lag("_last_key").over(in_order).eqNullSafe(F.col("_first_key"))
    has_previous = F.row_number().over(in_order) > 1
    return (
        summed.withColumn("_continued", continued & has_previous)
        .withColumns({name: F.lag(name).over(in_order) for name in combine})
        .where("_continued")
        .select("_slice", F.col("_first_key"), *combine)
    )


def _with_carried(rows: DataFrame, carried: DataFrame) -> DataFrame:
    started = F.broadcast(carried.withColumnRenamed("_slice", "_from_slice"))
    same = (F.col("_slice") == F.col("_from_slice")) & F.col("_key").eqNullSafe(F.col("_first_key"))
    return rows.join(started, same, "left").drop("_from_slice", "_first_key")


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """The position of each row in the order of slices and rows."""
    so_far = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("_slice").agg(F.count("*").alias("_count")).select(
        F.col("_slice").alias("_from_slice"), F.coalesce(F.sum("_count").over(so_far), F.lit(0)).alias("_before")
    )
    # Two numbers per slice, and a slice is one task of the sort.
    placed = rows.join(F.broadcast(before), F.col("_slice") == F.col("_from_slice"))
    return placed.withColumn(name, F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1 + F.col("_before")).drop(
        "_from_slice", "_before", *_HELPERS
    )


def running_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position"
) -> DataFrame:
    """1-based position of every row in its group; without keys, in the whole frame.

    `order` must leave no ties inside a group. Without keys the position is the row's place
    in its slice, which its row id holds, and the rows of the slices before: no second
    shuffle.
    """
    rows = sliced(df, keys, order)
    if not keys:
        return _numbered(rows, name)
    carried = _carried_into(
        rows, {"_count": F.count("*")}, {"_before": F.sum("_count")}
    )
    return (
        _with_carried(rows, carried)
        .withColumn(name, F.col("_here") + F.coalesce("_before", F.lit(0)))
        .drop("_here", "_before", *_HELPERS)
    )


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], path: str | None = None
) -> DataFrame:
    """A missing value takes the last one present before it in its group. The slices are stored at
    `path`, if given, and have to stay until the result has been read."""
    rows = sliced(df, keys, order, values, path)
    tail = {f"_tail_{v}": F.max_by(v, F.when(F.col(v).isNotNull(), F.col("_row"))) for v in values}
    combine = {f"_in_{v}": F.last(f"_tail_{v}", ignorenulls=True) for v in values}
    carried = _carried_into(rows, tail, combine)
    return (
        _with_carried(rows, carried)
        .withColumns({v: F.coalesce(f"_here_{v}", f"_in_{v}") for v in values})
        .drop(*_HELPERS, "_here", *[f"_here_{v}" for v in values], *[f"_in_{v}" for v in values])
    )
