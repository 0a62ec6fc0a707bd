"""Binned telemetry, changes between bins, values carried forward, daily alarms."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.dates import utc_day
from .closing import CLOSING, marks_closings

# The functions that tasks run are shipped by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: state of a bin is kept this long after the bin's time.
DELAY = "10 minutes"


def closed_bins(
    messages: DataFrame, keys: Sequence[str], ts: str, values: dict[str, Column], minutes: int = 10,
    delay: str = DELAY,
) -> DataFrame:
    """One row per (keys, bin) once the watermark has passed the bin's end.

    `values` are aggregates. They are combined before the shuffle, so a device that
    sends much of the data is no hot spot. Later messages of a closed bin are dropped.
    The closing rows of `with_closings` move the watermark and are in no bin.
    """
    marked = marks_closings(messages)
    return (
        marked.withWatermark(ts, delay)
        .groupBy(*keys, F.window(ts, f"{minutes} minutes").alias("w"), CLOSING)
        .agg(*[agg.alias(name) for name, agg in values.items()], no_closing())
        .where("_message")
        .select(*keys, F.col("w.end").alias("bin"), *values)
    )


def bin_changes(
    bins: DataFrame, keys: Sequence[str], values: Sequence[str], kept: Sequence[str] = (), minutes: int = 10,
    digits: int = 2, delay: str = DELAY,
) -> DataFrame:
    """Adds `<value>_change` since the bin before, per keys; 0.00 where that bin is absent.

    `bins` is a stream with one row per (keys, bin), in any order. It is joined with itself, a bin
    with the one that ends where it begins, whichever comes first; a bin without such a neighbour
    leaves once the watermark has passed it. The state holds the bins that the watermark has not
    passed, by key and bin, so neither a device nor a missing key gathers its history in one task.
    A bin that comes after the watermark has passed it is dropped: read landed bins without a
    limit of files, so that those which closed together come together.
    Values are compared in their own type; a null value gives a null change.
    """
    values, kept, width = list(values), list(kept), F.make_dt_interval(mins=F.lit(minutes))
    timed = marks_closings(bins).withColumns({"_bin": F.col("bin").cast("timestamp"), "_key": F.struct(F.lit(0), *keys)})
    own = timed.withWatermark("_bin", delay)
    before = timed.select(
        F.col("_key").alias("_before_key"), (F.col("_bin") + width).alias("_next"),
        *[F.col(v).alias(f"_before_{v}") for v in values], F.lit(True).alias("_found"),
    ).withWatermark("_next", delay)
    joined = own.join(before, (F.col("_key") == F.col("_before_key")) & (F.col("_bin") == F.col("_next")), "left")
    changes = {
        f"{v}_change": F.when(F.col("_found"), F.round(F.col(v) - F.col(f"_before_{v}"), digits)).otherwise(F.lit(0.0)) for v in values
    }
    # Asked of both sides, so that it cannot be asked before the watermark has seen the closing rows.
    return joined.where(F.coalesce("_found", ~F.col(CLOSING))).withColumns(changes).select(*keys, "bin", *kept, *values, *changes)


def no_closing() -> Column:
    """Whether a group is of messages. As an aggregate it is asked after the watermark has seen the
    closing rows; a filter on the grouping column would move below it."""
    return F.bool_and(~F.col(CLOSING)).alias("_message")


class Carrier(StatefulProcessor):
    """Fills absent values of a device from the last ones present."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], values: Sequence[str], state: T.StructType):
        self.columns, self.order, self.values, self.state = list(columns), list(order), list(values), state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", self.state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = list(self.held.get()) if self.held.exists() else [None] * len(self.values)
        place = {v: self.columns.index(v) for v in self.values}
        for row in sorted(rows, key=lambda r: [(r[o] is not None, r[o]) if r[o] is not None else (False,) for o in self.order]):
            out = list(row[c] for c in self.columns)
            for i, v in enumerate(self.values):
                if out[place[v]] is None:
                    out[place[v]] = held[i]
                held[i] = out[place[v]]
            yield Row(**dict(zip(self.columns, out, strict=True)))
        self.held.update(tuple(held))

    def close(self) -> None:
        pass


def carried(messages: DataFrame, device: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Messages with absent values filled from the same device's earlier ones.

    Messages are taken by `order` (nulls first) within a micro-batch, and batch after batch. The
    state is one row of values per device; a batch writes those of its own devices only. A task
    holds one device's rows of a micro-batch, so this is for sources whose rate bounds what a device
    sends in one; `carry_in_batches` is for any. Start it with `rocksdb_state`.
    """
    schema = messages.schema
    state = T.StructType([schema[v] for v in values])
    return messages.groupBy(device).transformWithState(
        Carrier(messages.columns, order, values, state), outputStructType=schema, outputMode="Append", timeMode="None"
    )


def alarm_stream(
    calls: DataFrame, name: str, ts: str, amount: Column, limit: int = 10, delay: str = DELAY
) -> DataFrame:
    """(name, day, total) once a UTC day has closed and its total reaches the limit."""
    return (
        marks_closings(calls).withWatermark(ts, delay)
        .groupBy(name, F.window(ts, "1 day").alias("w"), CLOSING)
        .agg(F.sum(amount).alias("total"), no_closing())
        .where(F.col("_message") & (F.col("total") >= limit))
        .select(name, utc_day("w.start").alias("day"), "total")
    )
