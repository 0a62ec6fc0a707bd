"""Date and time functions. Results are zone-free (`timestamp_ntz`) or dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import ColumnOrName, column

# Text layouts.
DAY_FIRST = "d/M/yyyy"
MONTH_FIRST = "M/d/yyyy"
ISO_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
YEAR_END_SUFFIX = "-12-31T23:59:59.999Z"
ISO_DATE_PATTERN = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
SLASHED_PATTERN = "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"
TIMESTAMP_PATTERN = (
    "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}([.][0-9]{1,6})?$"
)

# Texts are told apart by a pattern first and parsed by a cast where that can read
# the layout. A failing pattern costs far less than a failing parse, and the cast
# less than a formatter.


def parse_timestamp(c: ColumnOrName) -> Column:
    """`Y-m-d H:M:S` text with up to six fraction digits; any other text gives NULL."""
    c = column(c)
    return F.when(c.rlike(TIMESTAMP_PATTERN), c.try_cast("timestamp_ntz"))


def parse_iso_date(c: ColumnOrName) -> Column:
    c = column(c)
    return F.when(c.rlike(ISO_DATE_PATTERN), c.try_cast("date"))


def _slashed_date(c: ColumnOrName, layout: str) -> Column:
    c = column(c)
    return F.when(c.rlike(SLASHED_PATTERN), F.try_to_timestamp(c, F.lit(layout)).cast("date"))


def day_first_date(c: ColumnOrName) -> Column:
    """`d/m/Y` text, with or without leading zeros, to a date."""
    return _slashed_date(c, DAY_FIRST)


def mixed_layout_date(c: ColumnOrName) -> Column:
    """A column holding `Y-m-d` and `d/m/Y` texts; the layout decides, else NULL."""
    return F.coalesce(parse_iso_date(c), day_first_date(c))


def mixed_layout_timestamp(c: ColumnOrName) -> Column:
    return mixed_layout_date(c).cast("timestamp_ntz")


def date_of_text(c: ColumnOrName, length: int = 26) -> Column:
    """Date of a timestamp text cut to its first characters; blank gives NULL."""
    return parse_timestamp(F.substring(column(c), 1, length)).cast("date")


def month_first_iso(c: ColumnOrName) -> Column:
    """`m/d/Y` to ISO 8601 text; blank stays blank."""
    c = column(c)
    day = _slashed_date(c, MONTH_FIRST).cast("timestamp_ntz")
    return F.when(c == "", c).otherwise(F.date_format(day, ISO_STAMP))


def iso_stamp(ts: ColumnOrName) -> Column:
    return F.date_format(column(ts), ISO_STAMP)


def year_end_stamp(ts: ColumnOrName) -> Column:
    return F.concat(F.date_format(column(ts), "yyyy"), F.lit(YEAR_END_SUFFIX))


def months_before(d: ColumnOrName, months: int) -> Column:
    """Month arithmetic; the day is clipped to the month's end."""
    return F.add_months(column(d), -months)


def next_range_start(start: ColumnOrName, today: ColumnOrName, months: int = 1) -> Column:
    """Start of the next load range, never later than yesterday."""
    return F.least(F.add_months(column(start), months), F.date_sub(column(today), 1))


def covered_range_end(start: ColumnOrName, next_start: ColumnOrName, today: ColumnOrName) -> Column:
    """Last day that a range's file name states.

    A daily run states yesterday, a backfill clamped to yesterday the day before,
    any other the day before the next start.
    """
    yesterday = F.date_sub(column(today), 1)
    return F.when(
        column(next_start) == yesterday,
        F.when(column(start) == yesterday, yesterday).otherwise(F.date_sub(column(today), 2)),
    ).otherwise(F.date_sub(column(next_start), 1))


def shift_hours(ts: ColumnOrName, hours: int = 8) -> Column:
    return column(ts) + F.make_dt_interval(hours=F.lit(hours))


def utc_instant(ts: ColumnOrName) -> Column:
    """The instant of a zone-free UTC time, whatever the session's zone."""
    since = column(ts) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_seconds(since.cast("interval second").cast("decimal(20,6)"))


def utc_day(instant: ColumnOrName) -> Column:
    """The UTC calendar day of an instant."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(column(instant)) / 86_400).cast("int"))


def bin_end(ts: ColumnOrName, minutes: int = 10, keep_seconds: bool = False) -> Column:
    """End of the bin that holds `ts`: :00-:09 gives :10, :50-:59 the next full hour.

    `keep_seconds` leaves the whole seconds of `ts` on the result.
    """
    ts = column(ts)
    start = F.date_trunc("minute", ts).cast("timestamp_ntz")
    ahead = F.lit(minutes) - F.minute(ts) % F.lit(minutes)
    seconds = F.second(ts) if keep_seconds else F.lit(0)
    return start + F.make_dt_interval(mins=ahead, secs=seconds.cast("decimal(18,6)"))


def same_day_flag(first: ColumnOrName, second: ColumnOrName) -> Column:
    """1 where both fall on one day, else 0; 0 where one is missing."""
    return F.when(F.datediff(column(first), column(second)) == 0, 1).otherwise(0)

