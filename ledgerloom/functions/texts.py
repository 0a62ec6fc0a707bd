"""Text functions: address prefixes, seat numbers, names and query strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import ColumnOrName, column


def ip_prefix(ip: ColumnOrName, parts: int) -> Column:
    """The first parts of a dotted address; NULL if one is absent or empty."""
    found = F.regexp_extract(column(ip), f"^[^.]+([.][^.]+){{{parts - 1}}}", 0)
    return F.nullif(found, F.lit(""))


def seat_number(row: ColumnOrName, col: ColumnOrName) -> Column:
    """Row and column number joined; NULL if either is missing or no number."""
    return F.concat(column(row), column(col).try_cast("bigint").cast("string"))


def key_base(key: ColumnOrName) -> Column:
    """Part of an object key before its first dot."""
    return F.try_element_at(F.split(column(key), "[.]"), F.lit(1))


def key_extension(key: ColumnOrName) -> Column:
    """Part between the first and the second dot."""
    return F.try_element_at(F.split(column(key), "[.]"), F.lit(2))


def rendition_name(base: ColumnOrName, width: ColumnOrName, height: ColumnOrName, ext: ColumnOrName) -> Column:
    return F.concat(
        column(base), F.lit("_"), column(width).cast("string"),
        F.lit("_"), column(height).cast("string"), F.lit("."), column(ext),
    )


def numbered_parameters(values: Sequence[ColumnOrName | None]) -> Column:
    """`&ms1=..&ms2=..` in the given order; an absent value is written `NULL`.

    A `None` entry stands for a key that the data does not have.
    """
    pieces = []
    for i, value in enumerate(values, start=1):
        text = F.lit("NULL") if value is None else F.coalesce(column(value).cast("string"), F.lit("NULL"))
        pieces += [F.lit(f"&ms{i}="), text]
    return F.concat(*pieces)


def strip_label(line: ColumnOrName, label: str) -> Column:
    """A template line without its label, blanks and line ends."""
    return F.regexp_replace(F.replace(column(line), F.lit(label), F.lit("")), "[ \\n]", "")


def stable_id(kind: str, *parts: ColumnOrName) -> Column:
    """An id that depends on its key only, so that a rerun gives the same one. A missing part
    counts as a part of its own, unlike any text that names hold."""
    told = [F.coalesce(column(p).cast("string"), F.lit("\u001e")) for p in parts]
    return F.sha2(F.concat_ws("\u001f", F.lit(kind), *told), 256)


def hashed_fraction(seed: ColumnOrName, salt: str) -> Column:
    """A repeatable number in [0, 1) drawn from the first 32 hash bits of a key.

    It does not depend on the partitioning, so a task that runs again draws the same.
    """
    digest = F.md5(F.concat(column(seed).cast("string"), F.lit(":" + salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
