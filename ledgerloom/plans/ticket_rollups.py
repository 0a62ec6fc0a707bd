"""Ticket rollups by day, by day and show time, and by show."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import not_null_or_not_empty, safe_cast
from ..functions.dates import date_of_text, mixed_layout_date
from ..functions.labels import show_hour_label, showtime_band
from ..operators.lookups import drop_matches
from ..operators.measures import net_box_office
from ..operators.projection import with_headings

DAY_KEYS = ["movie_date", "location_id", "film_id", "hall_id", "hall_type"]
SHOW_KEYS = ["movie_date", "film_id", "location_id", "showtime", "showtime_grp", "hall_no", "hall_type"]

# The output tables' column headings.
DAY_HEADINGS = {
    "movie_date": "movie date", "location_id": "location id", "film_id": "tic_film_id",
    "hall_id": "tic_hall_id", "hall_type": "hall_type", "nbo": "NBO", "admission": "admission",
}
HOURLY_HEADINGS = {**DAY_HEADINGS, "show_time": "tic_show_time"}
SHOW_HEADINGS = {
    "movie_date": "movie date", "film_id": "movie id", "location_id": "location id",
    "total_seats": "total seats", "number_of_shows": "no of show",
}


def kept_tickets(tickets: DataFrame, refunds: DataFrame) -> DataFrame:
    """Booked tickets without a refund of the same booking and seat."""
    booked = tickets.where(F.col("tic_booking_id").isNotNull())
    refunded = refunds.where(not_null_or_not_empty("refund_booking_id")).select(
        safe_cast("refund_booking_id", "double").alias("_booking"), "refund_col_id", "refund_row_id"
    )
    same_seat = (
        (safe_cast("tic_booking_id", "double") == F.col("_booking"))
        & (F.col("tic_col_id") == F.col("refund_col_id"))
        & (F.col("tic_row_id") == F.col("refund_row_id"))
    )
    return drop_matches(booked, refunded, same_seat)


def with_halls(tickets: DataFrame, halls: DataFrame, hall_types: DataFrame) -> DataFrame:
    """Adds the hall of the location and its type's name; tickets without stay."""
    numbered = tickets.withColumn("tic_hall_id", safe_cast("tic_hall_id", "int"))
    at_location = (F.col("tic_hall_id") == F.col("hall_hall_id")) & (
        F.col("tic_loc_id") == F.col("hall_loca_id")
    )
    return numbered.join(halls, at_location, "left").join(
        hall_types, F.col("halltype") == F.col("halltype_id"), "left"
    )


def with_timetable(tickets: DataFrame, timetable: DataFrame) -> DataFrame:
    """Inner join on five keys whose types are aligned first."""
    shows = timetable.where(F.col("showid").isNotNull()).withColumn("showdate", date_of_text("showdate"))
    typed = tickets.withColumns(
        {c: safe_cast(c, "int") for c in ("tic_show_id", "tic_show_time", "tic_film_id")}
    )
    conditions = [
        F.col("showid") == F.col("tic_show_id"),
        F.col("locid") == F.col("tic_loc_id"),
        F.col("showdate") == safe_cast("tic_show_date", "date"),
        safe_cast("showtime", "int") == F.col("tic_show_time"),
        F.col("filmid") == F.col("tic_film_id"),
    ]
    return typed.join(shows, conditions, "inner")


def shown_tickets(
    tickets: DataFrame, refunds: DataFrame, halls: DataFrame, hall_types: DataFrame, timetable: DataFrame
) -> DataFrame:
    """The joined tickets that all three rollups are made of."""
    joined = with_timetable(with_halls(kept_tickets(tickets, refunds), halls, hall_types), timetable)
    return joined.select(
        mixed_layout_date(F.substring("tic_bus_date", 1, 26)).alias("movie_date"),
        F.col("tic_loc_id").alias("location_id"),
        F.col("tic_film_id").alias("film_id"),
        F.col("tic_hall_id").alias("hall_id"),
        F.col("hall_hall_id").alias("hall_no"),
        F.col("halltype_name").alias("hall_type"),
        F.col("tic_show_time").alias("show_time"),
        F.col("showid").alias("show_id"),
        F.col("totalseats").alias("total_seats"),
        net_box_office("tic_tkt_amt", "tic_tkt_gst_amt", "tic_tkt_ent_tax", "tic_tkt_surc_amt",
                       "tic_tkt_surc_gst_amt").alias("nbo"),
    )


def show_grain(shown: DataFrame) -> DataFrame:
    """The finest grain that all three rollups share.

    One shuffle of the tickets; the rollups then read this far smaller frame.
    """
    keys = ["movie_date", "location_id", "film_id", "hall_id", "hall_no", "hall_type", "show_time"]
    return shown.groupBy(*keys).agg(
        F.sum("nbo").alias("nbo"),
        F.count("*").alias("admission"),
        F.sum("total_seats").alias("total_seats"),
        F.count("show_id").alias("number_of_shows"),
    )


def rollup_day(grain: DataFrame) -> DataFrame:
    return grain.groupBy(*DAY_KEYS).agg(
        F.sum("nbo").alias("nbo"), F.sum("admission").alias("admission")
    )


def rollup_day_hour(grain: DataFrame) -> DataFrame:
    return grain.groupBy(*DAY_KEYS, "show_time").agg(
        F.sum("nbo").alias("nbo"), F.sum("admission").alias("admission")
    )


def rollup_both(grain: DataFrame) -> DataFrame:
    """Both levels from one pass; `level` is 0 with show time and 1 without."""
    keys = [*DAY_KEYS, "show_time"]
    return grain.groupingSets([keys, DAY_KEYS], *keys).agg(
        F.grouping("show_time").cast("int").alias("level"),
        F.sum("nbo").alias("nbo"),
        F.sum("admission").alias("admission"),
    )


def rollup_show(grain: DataFrame, strict_bands: bool = False) -> DataFrame:
    """Seats and shows counted once per ticket, as published so far."""
    banded = grain.withColumns(
        {
            "showtime": F.col("show_time"),
            "showtime_grp": showtime_band("show_time", strict_bands),
        }
    )
    return banded.groupBy(*SHOW_KEYS).agg(
        F.sum("total_seats").alias("total_seats"), F.sum("number_of_shows").alias("number_of_shows")
    )


def rollup_show_once(shown: DataFrame, strict_bands: bool = False) -> DataFrame:
    """As `rollup_show`, with every show counted once however many tickets it sold."""
    keys = ["movie_date", "location_id", "film_id", "hall_no", "hall_type", "show_time", "show_id"]
    once = shown.groupBy(*keys).agg(F.max("total_seats").alias("total_seats"))
    return rollup_show(once.withColumn("number_of_shows", F.lit(1)), strict_bands)


def with_show_hour(grain: DataFrame) -> DataFrame:
    """Adds the hour label of the show time."""
    return grain.withColumn("hourly_sales", show_hour_label("show_time"))


def published(grain: DataFrame) -> dict[str, DataFrame]:
    """The three tables under their published names and headings, all made of the one grain."""
    return {
        "new_tic_tbl_byday": with_headings(rollup_day(grain), DAY_HEADINGS),
        "new_tic_tbl_hourly": with_headings(rollup_day_hour(grain), HOURLY_HEADINGS),
        "new_showtime_hourly": with_headings(rollup_show(grain), SHOW_HEADINGS),
    }
