"""Casts that give NULL instead of an error, and blank-text defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: ColumnOrName, data_type: str) -> Column:
    """NULL where the text is not a value of the type."""
    return column(c).try_cast(data_type)


def safe_bigint(c: ColumnOrName) -> Column:
    return safe_cast(c, "bigint")


def safe_bigint_via_double(c: ColumnOrName) -> Column:
    """Also accepts whole numbers written with a fraction, such as `12.0`."""
    return safe_cast(safe_cast(c, "double"), "bigint")


def is_blank(c: ColumnOrName) -> Column:
    """TRUE for NULL and for the empty text."""
    return column(c).isNull() | (column(c) == "")


def not_blank(c: ColumnOrName) -> Column:
    return column(c).isNotNull() & (column(c) != "")


def not_null_or_not_empty(c: ColumnOrName) -> Column:
    """The loose form: a value passes if it is not empty or if it is not NULL."""
    return column(c).isNotNull() | (column(c) != "")


def number_or(c: ColumnOrName, default: float = 1.0) -> Column:
    """Text to double; blank text gives the default, other bad text NULL."""
    return F.when(is_blank(c), F.lit(float(default))).otherwise(safe_cast(c, "double"))


def percent_or(c: ColumnOrName, default: float = 1.0) -> Column:
    """As `number_or` for text such as `10%`."""
    return number_or(F.replace(column(c), F.lit("%"), F.lit("")), default)


def int_or_zero(c: ColumnOrName) -> Column:
    """Missing values become 0, fractions are cut."""
    return F.coalesce(column(c), F.lit(0)).try_cast("int")


def scaled_price(price: ColumnOrName, discount: ColumnOrName) -> Column:
    """price x 100 / discount; NULL where the discount is 0."""
    return F.try_divide(column(price) * F.lit(100), column(discount))


def text_left(c: ColumnOrName, length: int) -> Column:
    """The first characters of a value's text form."""
    return F.substring(column(c).cast("string"), 1, length)
