"""Landed feeds: JSON pages, report pages, XML responses, object events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import reading_or_zero

OBJECT_EVENT = (
    "Records array<struct<s3:struct<bucket:struct<name:string>,object:struct<key:string>>>>"
)
# Fixed value: the path of the readings inside a controller's response.
CONTROLLER_RESPONSE = (
    "Body struct<GetSlaveResponse:struct<GetSlaveResult:struct<Items:struct<"
    "Item:array<struct<Name:string,Value:string,Units:string>>>>>>"
)
REPORT_PAGE = "page_index long, columnHeaders array<struct<name:string>>, rows array<array<string>>"


def json_pages(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, one_per_file: bool = False
) -> DataFrame:
    """Landed pages, each a JSON array of records, one page per line.

    Records may have differing keys: fields are matched by name and absent ones are
    NULL. Without a schema Spark reads the pages once more to find it. Pages that
    span lines need `one_per_file`; such files cannot be split.
    """
    reader = spark.read.option("multiLine", one_per_file)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def report_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed report pages, one JSON document per line."""
    return spark.read.schema(REPORT_PAGE).json(path)


def report_rows(pages: DataFrame, columns: Sequence[str], page_size: int = 10_000) -> DataFrame:
    """Rows of report pages under the headings that each page brings along.

    A page that is longer than the page size repeats rows of the next one. Rows are
    told apart by their position in the whole report, so those are kept once.
    """
    names = F.transform("columnHeaders", lambda h: h["name"])
    rows = pages.select("page_index", names.alias("names"), F.posexplode("rows").alias("pos", "row"))
    cells = F.map_from_arrays("names", "row")
    return (
        rows.select(
            (F.col("page_index") * page_size + F.col("pos")).alias("position"),
            *[F.try_element_at(cells, F.lit(c)).alias(c) for c in columns],
        )
        .dropDuplicates(["position"])
    )


def xml_items(responses: DataFrame, keys: Sequence[str], body: str) -> DataFrame:
    """(keys, Name, Value, Units) of every item of XML responses."""
    parsed = F.from_xml(body, CONTROLLER_RESPONSE, {"ignoreNamespace": "true"})
    items = parsed["Body"]["GetSlaveResponse"]["GetSlaveResult"]["Items"]["Item"]
    return responses.select(*keys, F.explode_outer(items).alias("item")).select(*keys, "item.*")


def named_reading(
    responses: DataFrame, keys: Sequence[str], body: str, wanted: str = "Total system power"
) -> DataFrame:
    """One named reading per response as text.

    The first item of that name with all its fields counts; an empty value, and a
    response without the item, give `0.00`. The response stays one row throughout.
    """
    parsed = F.from_xml(body, CONTROLLER_RESPONSE, {"ignoreNamespace": "true"})
    items = parsed["Body"]["GetSlaveResponse"]["GetSlaveResult"]["Items"]["Item"]
    hits = F.filter(items, lambda i: (i["Name"] == wanted) & i["Units"].isNotNull())
    return responses.select(*keys, reading_or_zero(F.try_element_at(hits, F.lit(1))["Value"]).alias("reading"))


def object_events(events: DataFrame, keys: Sequence[str], body: str) -> DataFrame:
    """(keys, bucket, key) of every record of object-store event texts."""
    records = F.from_json(body, OBJECT_EVENT)["Records"]
    return events.select(*keys, F.explode(records).alias("r")).select(
        *keys, F.col("r.s3.bucket.name").alias("bucket"), F.col("r.s3.object.key").alias("key")
    )
