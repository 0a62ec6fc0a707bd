"""Whole records of CSV files that are read in blocks.

A field inside quotes may hold line ends, so whether a line starts a record depends on all lines
before it. A block is scanned for both cases, entered outside quotes and entered inside, and its
answer to each is one row: in which of them the next block is entered, and how many records begin.
A running pass over these rows, one per block of a file, tells each block's case and first record
number. Only records of several lines are shuffled.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.slices import stored

# The functions that tasks run are shipped by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a line is in either case: the number of records begun in the block up to it, whether it
# begins one, and whether it is inside quotes when it ends.
CASES = "begun0 long, starts0 boolean, ends0 boolean, begun1 long, starts1 boolean, ends1 boolean"
LINES = f"file string, block long, line long, value binary, {CASES}"
CLOSING = re.compile(rb'[^"]*+(?:""[^"]*+)*+"')


def inside_after(line: bytes, inside: bool, sep: bytes = b",") -> bool:
    """Whether a line that begins in or outside quotes ends inside them. A quote counts at the
    beginning of a field only; two of them inside quotes stand for one."""
    at = 0
    while True:
        if not inside:
            if not line.startswith(b'"', at):
                at = line.find(sep + b'"', at)
                if at < 0:
                    return False
                at += len(sep)
            at += 1
        closed = CLOSING.match(line, at)
        if closed is None:
            return True
        inside, at = False, line.find(sep, closed.end())
        if at < 0:
            return False
        at += len(sep)


def _scanned(skip: int, sep: bytes):
    """Lines of each block with what they are in both cases. The first `skip` lines of a file are
    records of their own, whatever quotes they hold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, line, state, begun = None, 0, [False, True], [0, 0]
        for batch in batches:
            values = batch.column("value")
            quoted = pc.greater(pc.count_substring(values, b'"'), 0).to_numpy(zero_copy_only=False)
            files, blocks = batch.column("file"), batch.column("block").to_numpy()
            new_file = np.concatenate(([True], pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False))) if len(batch) else []
            cuts = np.flatnonzero(np.asarray(new_file) | np.concatenate(([True], blocks[1:] != blocks[:-1]))) if len(batch) else []
            out = {f"{name}{k}": np.zeros(len(batch), kind) for k in (0, 1) for name, kind in (("begun", np.int64), ("starts", bool), ("ends", bool))}
            lines = np.zeros(len(batch), np.int64)
            for at, end in zip(cuts, [*cuts[1:], len(batch)], strict=True):
                block = (files[int(at)].as_py(), int(blocks[at]))
                if block != here:
                    here, line, state, begun = block, 0, [False, True], [0, 0]
                lines[at:end] = np.arange(line, line + end - at)
                top = max(0, min(skip - line, end - at)) if block[1] == 0 else 0
                for k in (0, 1):
                    before, now, last = np.zeros(end - at, bool), state[k], top
                    if top:
                        now = False
                    for i in np.flatnonzero(quoted[at + top : end]) + top:
                        before[last : i + 1] = now
                        now, last = inside_after(values[int(at + i)].as_py(), now, sep), i + 1
                    before[last:] = now
                    starts = ~before
                    out[f"starts{k}"][at:end] = starts
                    out[f"begun{k}"][at:end] = begun[k] + np.cumsum(starts)
                    out[f"ends{k}"][at:end] = np.append(before[1:], now)
                    state[k], begun[k] = now, begun[k] + int(starts.sum())
                line += int(end - at)
            yield pa.RecordBatch.from_arrays(
                [files, batch.column("block"), pa.array(lines), values, *map(pa.array, out.values())],
                ["file", "block", "line", "value", *out],
            )

    return run


def _placed(blocks: DataFrame, drop: int) -> DataFrame:
    """(file, block, inside, before, row_before): the case in which a block is entered, the
    records that begin before it in its file, and the rows of all files before its own.

    `blocks` has one row per block, so a file's rows stay few whatever its size.
    """
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # A block leads both cases to one end, or turns them round, or leaves them.
    turned = blocks.withColumn("turns", F.sum((F.col("ends0") & ~F.col("ends1")).cast("int")).over(in_file)).withColumn(
        "settled", F.when(F.col("ends0") == F.col("ends1"), F.struct("ends0", "turns"))
    )
    entered = turned.withColumns(
        {"last": F.last("settled", ignorenulls=True).over(earlier), "before_turns": F.lag("turns", 1, 0).over(Window.partitionBy("file").orderBy("block"))}
    ).withColumn(
        "inside",
        F.coalesce(F.col("last.ends0"), F.lit(False)) != ((F.col("before_turns") - F.coalesce(F.col("last.turns"), F.lit(0))) % 2 == 1),
    )
    counted = entered.withColumn("begins", F.when(F.col("inside"), F.col("begun1")).otherwise(F.col("begun0"))).withColumn(
        "before", F.coalesce(F.sum("begins").over(earlier), F.lit(0))
    )
    by_name = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = counted.groupBy("file").agg(F.greatest(F.sum("begins") - drop, F.lit(0)).alias("rows")).select(
        "file", F.coalesce(F.sum("rows").over(by_name), F.lit(0)).alias("row_before")
    )
    return counted.join(files, "file").select("file", "block", "inside", "before", "row_before")


def file_records(
    spark: SparkSession, path: str, encoding: str = "UTF-8", skip: int = 0, header: bool = True, sep: str = ","
) -> DataFrame:
    """(file, row_no, record): the records of CSV files, each with the line ends inside its quotes.

    `row_no` counts from 0 over all files in the order of their names and places. `skip` lines
    and then, with `header`, one record are left out of each file. Files are split: the lines are
    scanned once, stored with what they are in both cases, and told apart by their block's row.
    A quote that is never closed runs to the end of its file.
    """
    drop = skip + header
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )
    # Stored, as blocks are cut by the cores at hand and both passes have to see the same ones.
    scanned = stored(lines.mapInArrow(_scanned(skip, sep.encode()), LINES), "lines")
    last = F.max_by(F.struct("begun0", "ends0", "begun1", "ends1"), "line").alias("last")
    blocks = scanned.groupBy("file", "block").agg(last).select("file", "block", "last.*")

    def case(name: str) -> Column:
        return F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    text = F.col("value").cast("string") if encoding.upper() == "UTF-8" else F.decode("value", encoding)
    number = F.col("before") + case("begun") - 1
    told = scanned.join(_placed(blocks, drop), ["file", "block"]).select(
        "file", "block", "line", text.alias("value"), number.alias("number"),
        (F.col("row_before") + number - drop).alias("row_no"), (case("starts") & ~case("ends")).alias("single"),
    ).where(F.col("number") >= drop)
    single = told.where("single").select("file", "row_no", "value")
    pieces = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    several = told.where("NOT single").groupBy("file", "row_no").agg(
        F.array_join(F.transform(pieces, lambda piece: piece["value"]), "\n").alias("value")
    )
    whole = single.unionByName(several)
    return whole.select("file", "row_no", F.regexp_replace("value", "\r\\z", "").alias("record"))


def parsed(records: DataFrame, schema: str, *kept: str) -> DataFrame:
    """Records as columns, behind the kept ones; empty records are no rows."""
    row = F.from_csv("record", schema, {"quote": '"', "escape": '"'})
    return records.where("record <> ''").select(*kept, row.alias("_row")).select(*kept, "_row.*")
