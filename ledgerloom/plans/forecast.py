"""Forecast training table: item sales with a holiday flag, latest months held out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_first_date
from ..functions.labels import any_present_flag
from ..operators.measures import hold_out_months

HOLIDAY_FLAGS = ["isKLPublicHoliday", "isSelangorPublicHoliday", "isSchoolHoliday"]
OUTPUT = ["Item Number", "Day", "isHoliday"]


def holidays(calendar: DataFrame, months: int = 6) -> DataFrame:
    """(date, isHoliday) up to the cut. Any flag with a value counts, also a zero."""
    flagged = calendar.select(
        day_first_date("date").alias("date"), any_present_flag(*HOLIDAY_FLAGS).alias("isHoliday")
    )
    return hold_out_months(flagged, "date", months)


def training_sales(sales: DataFrame, months: int = 6) -> DataFrame:
    return hold_out_months(sales.withColumn("Day", day_first_date("Day")), "Day", months)


def forecast_table(sales: DataFrame, calendar: DataFrame, months: int = 6) -> DataFrame:
    joined = training_sales(sales, months).join(
        holidays(calendar, months), F.col("Day") == F.col("date"), "inner"
    )
    return joined.select(*OUTPUT)
