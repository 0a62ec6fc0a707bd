"""CSV, sheet exports, text lines and archive listings."""

from __future__ import annotations

import zipfile
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.slices import stored
from .records import file_records, parsed


def latin_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Comma CSV with a header row in Latin-1, line ends inside quotes kept; files are split."""
    return parsed(file_records(spark, path, "ISO-8859-1"), ddl(schema))


def numbered_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As `latin_csv` with blanks as empty text and `row_no` rising with the order of the files'
    names and of their rows. Stored, as loads read the rows many times."""
    rows = parsed(file_records(spark, path, "ISO-8859-1"), ddl(schema), "row_no")
    filled = rows.select("row_no", *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in schema.names])
    return stored(filled, "landed-rows")


def csv_columns(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str]) -> DataFrame:
    """Some columns of a CSV with a header row; the parser skips the others."""
    return spark.read.schema(schema).option("header", True).csv(path).select(*columns)


def sheet_export(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str], preamble: int = 4
) -> DataFrame:
    """A sheet exported as CSV: preamble lines, a header line, then rows, which may hold line ends
    inside quotes. Files are split; what is counted of a block is one row."""
    rows = parsed(file_records(spark, path, skip=preamble), ddl(schema))
    return rows.select(*[F.col(f"`{c}`") for c in columns])


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def text_lines(spark: SparkSession, path: str, containing: str | None = None) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.where(F.col("value").contains(containing)) if containing else lines


def _member_lister():
    """The function that lists archives on executors.

    It is made here so that Spark ships its code; executors need no copy of this
    package.
    """

    def open_seekable(uri: str):
        from pyarrow import fs

        if uri.startswith("file:"):
            uri = "file:///" + uri[len("file:"):].lstrip("/")
        system, path = fs.FileSystem.from_uri(uri)
        return system.open_input_file(path)

    def list_members(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                with open_seekable(uri) as handle, zipfile.ZipFile(handle) as archive:
                    found = [(uri, i, m.filename, m.file_size) for i, m in enumerate(archive.infolist())]
                yield pd.DataFrame(found, columns=["archive", "pos", "filename", "size"])

    return list_members


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, pos, filename, size) of every member of every zip below a path.

    Only the archives' own directories are read, never their contents, which the
    column pruning of the scan leaves out.
    """
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")
    return archives.mapInPandas(
        _member_lister(), "archive string, pos long, filename string, size long"
    )
