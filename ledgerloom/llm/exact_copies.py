"""Exact deduplication with an extendible-hash index on shared files."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, spread, stored, texts_of

WHITE = "\t\n\x0b\x0c\r "
SEGMENT = (
    "bucket int, key long, norm string, rep long, members array<long>, rows array<long>, n long, best_size long, "
    "best_id long, best_row long"
)
CHAINED = "rep long, key long, chain int, n long, best_size long, best_id long, best_row long, text_sha256 string"


def directory(counts: np.ndarray, capacity: int) -> np.ndarray:
    """The bucket of each slot of a directory with len(counts) slots, a power of two.

    It starts as one bucket of depth 0. A bucket over `capacity` is split by its next bit,
    and where its depth has reached the directory's, the directory doubles. The slots hold
    the leading bits of a key, so a bucket is a range of keys. A bucket that is still too
    full at the last depth keeps its entries, which its owner chains.
    """
    top = len(counts).bit_length() - 1
    sums = np.concatenate(([0], np.cumsum(counts)))
    depth, slots = 0, np.zeros(1, np.int64)
    ranges = [(0, len(counts), 0)]  # bucket -> (first slot at the last depth, end, own depth)
    todo = [0]
    while todo:
        bucket = todo.pop()
        low, high, own = ranges[bucket]
        if sums[high] - sums[low] <= capacity or own == top:
            continue
        if own == depth:
            slots, depth = np.repeat(slots, 2), depth + 1
        middle = (low + high) // 2
        ranges[bucket] = (low, middle, own + 1)
        ranges.append((middle, high, own + 1))
        width = len(counts) // len(slots)
        slots[middle // width : high // width] = len(ranges) - 1
        todo += [bucket, len(ranges) - 1]
    return np.repeat(slots, len(counts) // len(slots))


def _segments(budget: int, starts: np.ndarray, shift: int):
    """Entries of one task: a text that the task meets again becomes a member of the entry
    it already has, after a comparison of the texts. What is held is written out at
    `budget` characters; the owner joins the parts again."""

    def run(frames):
        task = TaskContext.get().partitionId() << 33
        found: dict[str, list] = {}
        held = seen = 0

        def out():
            frame = pd.DataFrame(
                [(key, norm, own[0], docs, own, len(own), *best) for norm, (key, docs, own, best) in found.items()],
                columns=["key", "norm", "rep", "members", "rows", "n", "best_size", "best_id", "best_row"],
            )
            found.clear()
            frame.insert(0, "bucket", np.searchsorted(starts, frame.key.to_numpy(np.int64) >> shift, side="right") - 1)
            return frame

        for frame in frames:
            for doc, size, norm, key in zip(frame.doc_id, frame.n_cp, frame.norm, frame.key, strict=True):
                row = task + seen
                seen += 1
                entry = found.get(norm)
                if entry is None:
                    held += len(norm) + 200
                    found[norm] = [key, [doc], [row], (size, doc, row)]
                else:
                    entry[1].append(doc)
                    entry[2].append(row)
                    held += 64
                    if (-size, doc, row) < (-entry[3][0], *entry[3][1:]):
                        entry[3] = (size, doc, row)
                if held > budget:
                    yield out()
                    held = 0
        if found:
            yield out()

    return run


def _owner(frames):
    """Chains the entries of a range of keys, which arrive sorted by key: entries of one key
    hang in a chain, one link for each distinct text, told apart by their bytes."""
    import hashlib

    current, links, rows = None, {}, []

    def close():
        for place, (digest, n, best, reps) in enumerate(links.values()):
            rows.extend((rep, current, place, n, *best, digest) for rep in reps)
        links.clear()

    def out():
        frame = pd.DataFrame(
            rows, columns=["rep", "key", "chain", "n", "best_size", "best_id", "best_row", "text_sha256"]
        )
        rows.clear()
        return frame

    for frame in frames:
        for key, norm, rep, n, size, doc, row in zip(
            frame.key, frame.norm, frame.rep, frame.n, frame.best_size, frame.best_id, frame.best_row, strict=True
        ):
            if key != current:
                close()
                current = key
            link = links.get(norm)
            if link is None:
                links[norm] = [hashlib.sha256(norm.encode()).hexdigest(), n, (size, doc, row), [rep]]
            else:
                link[1] += n
                link[3].append(rep)
                if (-size, doc, row) < (-link[2][0], *link[2][1:]):
                    link[2] = (size, doc, row)
        if len(rows) > 20_000:
            yield out()
    close()
    yield out()


def exact_copies(
    documents: DataFrame, capacity: int = 4096, bits: int = 16, budget: int = 16_000_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without the characters `[\\x20\\x09-\\x0D]`. Of
    equal texts the longest original stays, then the smallest id, then the first row.

    1. Keys are counted by their leading `bits`, and the directory is split until no bucket
       holds more than `capacity`; only these 2**bits counts reach the driver.
    2. Every scan task joins the copies it meets itself and writes one entry per distinct
       text to the shared files of the index: a text that a third of all rows share is one
       entry per task.
    3. Buckets are dealt to owner tasks, which chain the entries of each key and compare
       bytes. Their result goes back to the entries' members by a join of numbers.

    Null or empty text: the empty text, one group. Null id: left out. Repeated rows: rows of
    one group, of which one is kept. No documents: no rows.
    """
    spark = documents.sparkSession
    norm = F.translate("text", WHITE, "")
    docs = texts_of(documents, id_col, text_col).select(
        "doc_id", F.length("text").cast("long").alias("n_cp"), norm.alias("norm"), spread(norm).alias("key")
    )
    slot = F.shiftrightunsigned("key", 63 - bits)
    counts = np.zeros(1 << bits, np.int64)
    for row in docs.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).toLocalIterator():
        counts[row["slot"]] = row["n"]
    buckets = directory(counts, capacity)
    starts = np.flatnonzero(np.diff(buckets, prepend=-1))  # first slot of each bucket: 2**bits at most
    entries = stored(docs.mapInPandas(_segments(budget, starts, 63 - bits), SEGMENT), "segments")
    owners = min(len(starts), max(shuffle_partitions(spark), len(starts) // 64))
    chained = (
        entries.select("bucket", "key", "norm", "rep", "n", "best_size", "best_id", "best_row")
        .repartition(owners, "bucket").sortWithinPartitions("key").mapInPandas(_owner, CHAINED)
    )
    members = entries.select("rep", F.explode(F.arrays_zip("members", "rows")).alias("m"))
    return members.join(chained, "rep").select(
        F.col("m.members").alias("doc_id"), F.col("best_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("m.rows") == F.col("best_row")).alias("kept"), "text_sha256",
    )
