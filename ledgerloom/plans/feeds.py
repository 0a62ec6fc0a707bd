"""Incremental exports of landed feeds."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import next_range_start
from ..sinks.files import csv_with_header, range_named_path
from ..sources.feeds import report_rows

# The columns of the two reports.
VISIT_COLUMNS = [
    "ga:userType", "ga:browser", "ga:deviceCategory", "ga:date", "ga:country", "ga:medium",
    "ga:channelGrouping", "ga:sessions", "ga:transactionsPerSession", "ga:bounceRate", "ga:exitRate",
    "ga:users",
]
COST_COLUMNS = ["ga:transactionId", "ga:date", "ga:transactionRevenue"]


def load_range(start: str | None, today: str) -> tuple[date, date, bool]:
    """(start, next start, is backfill) of one run; without a start it is yesterday's."""
    run_day = date.fromisoformat(today)
    yesterday = run_day - timedelta(days=1)
    first = date.fromisoformat(start) if start else yesterday
    if first == yesterday:
        return first, yesterday, False
    month = first.month % 12 + 1
    year = first.year + (1 if first.month == 12 else 0)
    last_day = (date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)).day
    following = date(year, month, min(first.day, last_day))
    return first, min(following, yesterday), True


def range_end_label(start: date, following: date, today: str) -> date:
    """Last day that the run's file name states."""
    yesterday = date.fromisoformat(today) - timedelta(days=1)
    if following != yesterday:
        return following - timedelta(days=1)
    return yesterday if start == yesterday else yesterday - timedelta(days=1)


def updated_in_range(records: DataFrame, start: str | None, today: str, updated: str = "updated_at") -> DataFrame:
    """Records updated since the start and before the next one; a daily run takes
    yesterday in full."""
    first, following, backfill = load_range(start, today)
    day = F.to_date(updated)
    cut = day < F.lit(following) if backfill else day <= F.lit(following)
    return records.where((day >= F.lit(first)) & cut)


def export_range(records: DataFrame, folder: str, name: str, start: str | None, today: str,
                 order: list[str]) -> str:
    """One range as CSV in feed order, in a folder that states the days covered.

    Returns the folder. The order is a distributed sort: part files follow one
    another.
    """
    first, following, _ = load_range(start, today)
    path = range_named_path(folder, name, str(first), str(range_end_label(first, following, today)))
    csv_with_header(updated_in_range(records, start, today).orderBy(*order), path)
    return path


def month_chunks(bounds: DataFrame, start: str, end: str, today: str) -> DataFrame:
    """Backfill ranges [range_start, range_end) of one month each, clamped to yesterday."""
    starts = F.sequence(F.col(start), F.col(end), F.expr("interval 1 month"))
    return bounds.select(F.explode(starts).alias("range_start")).withColumn(
        "range_end", next_range_start("range_start", F.lit(today).cast("date"))
    )


def web_report(pages: DataFrame, cost: bool = False, page_size: int = 10_000) -> DataFrame:
    return report_rows(pages, COST_COLUMNS if cost else VISIT_COLUMNS, page_size)


def report_range(start: str | None, end: str | None, today: str) -> str:
    """The days that a report's file name states: the given ones, else yesterday."""
    if start and end:
        return f"{start}_{end}"
    return str(date.fromisoformat(today) - timedelta(days=1))


def next_report_range(start: str, today: str) -> tuple[date, date]:
    """Start and end of the run after one that began on `start`: one and two months on, neither
    later than the day before yesterday."""
    latest = date.fromisoformat(today) - timedelta(days=2)
    first = date.fromisoformat(start)

    def months_on(months: int) -> date:
        ahead = first.month - 1 + months
        year, month = first.year + ahead // 12, ahead % 12 + 1
        last_day = (date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)).day
        return min(date(year, month, min(first.day, last_day)), latest)

    return months_on(1), months_on(2)


def export_report(
    pages: DataFrame, folder: str, today: str, start: str | None = None, end: str | None = None, cost: bool = False,
    page_size: int = 10_000,
) -> str | None:
    """A report as CSV in its own order and under its own headings, in a folder that states the
    days covered. Returns the folder; None, and nothing is written, where the report has no rows."""
    rows = web_report(pages, cost, page_size)
    if rows.isEmpty():
        return None
    name = "ga-cost-data" if cost else "ga-data"
    path = f"{folder}/{name}({report_range(start, end, today)}){uuid.uuid4()}.csv"
    csv_with_header(rows.orderBy("position").drop("position"), path)
    return path
