"""Incremental loads that remember how far they came.

Each run lands the next range of a feed: yesterday, or of a feed that is behind, a month, never
later than yesterday. The start is the ledger's high-water mark, so no argument has to be kept
between runs, and a run that fails at any point is simply run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from urllib.parse import quote

from pyspark.sql import DataFrame

from ..sinks.ledger import Ledger, Load
from .feeds import load_range, range_end_label, updated_in_range


def next_load(ledger: Ledger, feed: str, folder: str, today: str, start: str | None = None) -> Load | None:
    """The range that comes next, and a folder for it that no other run has; None when all days up
    to yesterday are there. `start` counts for a feed without entries; without it the first load
    is yesterday's."""
    first = ledger.high_water(feed) or start
    yesterday = date.fromisoformat(today) - timedelta(days=1)
    if first is not None and date.fromisoformat(first) > yesterday:
        return None
    begin, following, backfill = load_range(first, today)
    # A daily load takes its day in full, a backfill ends before the next start.
    until = following if backfill else following + timedelta(days=1)
    label = range_end_label(begin, following, today)
    return Load(feed, str(begin), str(until), str(label), f"{folder}/{quote(feed, safe='')}({begin}_{label}){uuid.uuid4().hex}")


def land_next(
    records: DataFrame, ledger: Ledger, feed: str, folder: str, today: str, start: str | None = None,
    updated: str = "updated_at", before_entry: Callable[[Load], None] | None = None,
) -> Load | None:
    """Lands the next range of a feed as Parquet and enters it; None when nothing is due.

    The filter on `updated` reaches the scan, so a run reads its range only where the feed lies
    in dated folders or sorted files. `before_entry` is called between write and entry. Where
    another run has entered the range meanwhile, this run's folder stays unread.
    """
    load = next_load(ledger, feed, folder, today, start)
    if load is None:
        return None
    updated_in_range(records, load.first, today, updated).write.parquet(load.folder)
    if before_entry:
        before_entry(load)
    ledger.enter(load)
    return load


def catch_up(
    records: DataFrame, ledger: Ledger, feed: str, folder: str, today: str, start: str | None = None,
    updated: str = "updated_at", before_entry: Callable[[Load], None] | None = None,
) -> list[Load]:
    """Lands range after range until yesterday is in: one job a month that the feed is behind."""
    loads = []
    while load := land_next(records, ledger, feed, folder, today, start, updated, before_entry):
        loads.append(load)
    return loads
