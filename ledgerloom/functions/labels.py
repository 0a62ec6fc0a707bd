"""Conditional columns: channels, hour labels, bands and 0/1 flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import ColumnOrName, column

# The texts of the show time bands.
BAND_MIDNIGHT = "Midnight (10pm onwards)"
BAND_EARLY = "Early (before 1pm)"
BAND_AFTERNOON = "Afternoon (1pm - 5:59pm)"
BAND_EVENING = "Evening (6pm - 9:59pm)"


def sale_platform(platform: ColumnOrName, pos: ColumnOrName) -> Column:
    """ONLINE, KIOSK or POS. A missing platform counts as POS."""
    own = column(platform) == ""
    pos = column(pos)
    return (
        F.when(own & (pos == "EPAY"), "ONLINE")
        .when(own & pos.like("%KIOSK%"), "KIOSK")
        .otherwise("POS")
    )


def sale_source(platform: ColumnOrName, pos: ColumnOrName) -> Column:
    """As `sale_platform`, with the phone apps told apart as MOBILE."""
    own = column(platform) == ""
    pos = column(pos)
    return (
        F.when(own & (pos == "EPAY"), "ONLINE")
        .when(own & pos.like("%KIOSK%"), "KIOSK")
        .when(own & pos.isin("IOS", "ANDROID"), "MOBILE")
        .otherwise("POS")
    )


def hour_label(ts: ColumnOrName) -> Column:
    """Two-digit label on the 12-hour clock; noon has no label."""
    hour = F.hour(column(ts))

    def two_digits(h: Column) -> Column:
        return F.lpad(h.cast("string"), 2, "0")

    return (
        F.when(hour < 12, F.concat(two_digits(hour), F.lit(":00AM")))
        .when(hour > 12, F.concat(two_digits(hour - 12), F.lit(":00PM")))
    )


def show_hour_label(showtime: ColumnOrName) -> Column:
    """Label of an HHMM number: `0` before any morning hour, no padding after noon."""
    hour = F.floor(column(showtime) / 100).cast("int")
    return (
        F.when(hour < 12, F.concat(F.lit("0"), hour.cast("string"), F.lit(":00AM")))
        .otherwise(F.concat((hour - 12).cast("string"), F.lit(":00PM")))
    )


def showtime_band(showtime: ColumnOrName, strict: bool = False) -> Column:
    """Band of an HHMM number.

    By default any time from 05:60 to 22:59 is the early band, as in the figures
    published so far. `strict` gives the four bands that their names describe.
    """
    t = column(showtime)
    if not strict:
        return F.when((t >= 2300) | (t <= 559), BAND_MIDNIGHT).when(t.isNotNull(), BAND_EARLY)
    return (
        F.when((t >= 2200) | (t <= 559), BAND_MIDNIGHT)
        .when(t.between(600, 1259), BAND_EARLY)
        .when(t.between(1300, 1759), BAND_AFTERNOON)
        .when(t.between(1800, 2159), BAND_EVENING)
    )


def connection_type(carrier: ColumnOrName) -> Column:
    """wifi where the carrier is empty; 3g otherwise, also where it is missing."""
    return F.when(column(carrier) == "", "wifi").otherwise("3g")


def free_sale_flag(offer: ColumnOrName) -> Column:
    return F.when(column(offer).isNull(), "1").otherwise("0")


def pixel_flags(offer: ColumnOrName, price: ColumnOrName) -> tuple[Column, Column]:
    """(free, paid): an offer is present and its price is zero, or is not."""
    present = column(offer).isNotNull()
    free = F.when(present & (column(price) == 0), 1).otherwise(0)
    paid = F.when(present & (column(price) != 0), 1).otherwise(0)
    return free, paid


def any_present_flag(*cols: ColumnOrName) -> Column:
    """`'1'` where any of the columns has a value (a zero counts), else `'0'`."""
    return F.when(F.coalesce(*[column(c) for c in cols]).isNotNull(), "1").otherwise("0")


def prefixed_code(code: ColumnOrName, longest_short: int) -> Column:
    """One `0` in front of codes of at most `longest_short` characters."""
    code = column(code)
    return F.when(F.length(code) <= longest_short, F.concat(F.lit("0"), code)).otherwise(code)


def reading_or_zero(value: ColumnOrName) -> Column:
    """Missing and empty readings become `0.00`."""
    return F.coalesce(F.nullif(column(value), F.lit("")), F.lit("0.00"))
