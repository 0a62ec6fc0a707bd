"""Film table: columns and storage layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.tables import bucketed_table, clustered_parquet

# The table's columns in order. Columns that are not text are named below.
COLUMNS = [
    "film_approve_by", "film_approve_datetime", "film_check_by", "film_check_datetime",
    "film_content_from", "film_created_by", "film_created_on", "film_date_freelist",
    "film_date_in", "film_date_out", "film_director", "film_distributor_id", "film_duration",
    "film_film_parent_id", "film_film_sequel_id", "film_first_screen_date", "film_flm_effects",
    "film_freelist_policy_id", "film_genre_id", "film_hide_from_collection", "film_id",
    "film_language_id", "film_main_stars", "film_modify_by", "film_modify_datetime", "film_old_id",
    "film_poster_filename", "film_print_in_circ", "film_print_in_ctry", "film_rating_id",
    "film_reels", "film_reference_code", "film_release_date", "film_remark", "film_short_title",
    "film_sound_format", "film_special_event", "film_status", "film_studio", "film_subtitle_id",
    "film_synopsis", "film_title", "film_trailer_url", "last_opr", "last_opr_date",
    "last_opr_funct", "last_version",
]
WHOLE_NUMBERS = {"film_duration", "film_id", "film_print_in_circ", "film_print_in_ctry", "last_version"}
REALS = {
    "film_film_parent_id", "film_film_sequel_id", "film_freelist_policy_id", "film_old_id",
    "film_reels", "film_studio",
}
DISTRIBUTION_KEY = "film_id"
SORT_KEY = "film_approve_datetime"


def _kind(name: str) -> T.DataType:
    if name in WHOLE_NUMBERS:
        return T.LongType()
    return T.DoubleType() if name in REALS else T.StringType()


SCHEMA = T.StructType([T.StructField(name, _kind(name)) for name in COLUMNS])


def film_rows(df: DataFrame) -> DataFrame:
    """The frame in the table's columns and types; columns it lacks are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in SCHEMA.fields
        ]
    )


def write_films(df: DataFrame, path: str) -> None:
    clustered_parquet(film_rows(df), path, DISTRIBUTION_KEY, SORT_KEY)


def save_film_table(df: DataFrame, table: str, buckets: int = 16) -> None:
    bucketed_table(film_rows(df), table, buckets, DISTRIBUTION_KEY, SORT_KEY)
