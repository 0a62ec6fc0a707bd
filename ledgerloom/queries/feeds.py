"""Landed feeds: events as JSON pages, report pages, XML responses and object events."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import covered_range_end, next_range_start
from ..operators.sets import append_all
from ..plans.feeds import export_report
from ..plans.feeds import month_chunks as chunks_of
from ..plans.feeds import updated_in_range, web_report as web_report_of
from ..plans.increments import catch_up, land_next
from ..session import scratch_dir
from ..sinks.ledger import Ledger, Load
from ..sources import feeds
from ..sources.tables import GATEWAY_TABLE, create_view, gateway_table
from .base import derive, sql, table


def scan_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table named by a job argument, pruned by a mapping list."""
    events = table(spark, sf_dir, "events")
    create_view(events, GATEWAY_TABLE.format(gateway="site", country="my", part="events"))
    mapping = [
        ("event_id", "bigint", "id", "bigint"),
        ("event_type", "string", "kind", "string"),
        ("user_id", "bigint", "user", "string"),
    ]
    return gateway_table(spark, "site_my", "events", mapping)


RECORDS = """SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value,
    CASE WHEN event_id % 2 = 0 THEN event_type END AS kind, CAST(ts AS STRING) AS updated_at FROM {events}"""
PAGE_SIZE = 100


def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as pages of 100, absent keys left out, and read back as one list."""
    records = derive(spark, sf_dir, RECORDS)
    pages = records.groupBy(F.floor(F.col("id") / PAGE_SIZE).alias("page")).agg(
        F.collect_list(F.to_json(F.struct("*"))).alias("records")
    )
    path = scratch_dir(spark, "json-pages")
    pages.select(F.concat(F.lit("["), F.array_join("records", ","), F.lit("]"))).write.text(path)
    return feeds.json_pages(spark, path, "id long, kind string, updated_at string, value double")


REPORT = """SELECT event_id AS id, CAST(floor(event_id / 100) AS BIGINT) AS page_index, user_id, event_type,
    substr(CAST(ts AS STRING), 1, 10) AS day, CAST(value AS STRING) AS revenue FROM {events}"""


def _report_pages(spark: SparkSession, sf_dir: str, cells: dict[str, str]) -> DataFrame:
    """Report pages of 100 rows; every page also repeats the first row of the next one."""
    rows = derive(spark, sf_dir, REPORT)
    repeated = rows.where("id % 100 = 0 AND id > 0").withColumn("page_index", F.col("page_index") - 1)
    row = F.struct("id", F.array(*[F.col(c).cast("string") for c in cells.values()]).alias("cells"))
    pages = rows.unionByName(repeated).groupBy("page_index").agg(F.sort_array(F.collect_list(row)).alias("r"))
    path = scratch_dir(spark, "report-pages")
    headers = F.array(*[F.struct(F.lit(name).alias("name")) for name in cells])
    pages.select("page_index", headers.alias("columnHeaders"), F.col("r.cells").alias("rows")).write.json(path)
    return feeds.report_pages(spark, path)


def web_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = {"ga:sessions": "id", "ga:date": "day", "ga:userType": "event_type", "ga:users": "user_id"}
    report = web_report_of(_report_pages(spark, sf_dir, cells), page_size=100)
    return report.select("position", "`ga:sessions`", "`ga:date`", "`ga:userType`", "`ga:users`", "`ga:browser`")


def web_cost_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = {"ga:transactionId": "id", "ga:date": "day", "ga:transactionRevenue": "revenue"}
    return web_report_of(_report_pages(spark, sf_dir, cells), cost=True, page_size=100)


def web_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both reports written under their range names and read back: the visits of a month, and
    yesterday's costs, whose rows are the whole table here."""
    folder = scratch_dir(spark, "reports")
    visits = {"ga:sessions": "id", "ga:date": "day", "ga:userType": "event_type", "ga:users": "user_id"}
    costs = {"ga:transactionId": "id", "ga:date": "day", "ga:transactionRevenue": "revenue"}
    written = [
        export_report(_report_pages(spark, sf_dir, visits), folder, "2024-03-01", "2024-01-01", "2024-02-01", page_size=100),
        export_report(_report_pages(spark, sf_dir, costs), folder, "2024-03-01", cost=True, page_size=100),
    ]
    read = [spark.read.option("header", True).csv(path) for path in written]
    named = [
        (read[0], ["ga:sessions", "ga:date", "ga:userType", "ga:browser"]),
        (read[1], ["ga:transactionId", "ga:date", "ga:transactionRevenue"]),
    ]
    return append_all([
        df.select(
            F.lit(path.rsplit("/", 1)[1].split(")")[0]).alias("file"), F.col(f"`{columns[0]}`").alias("id"), F.col(f"`{columns[1]}`").alias("day"),
            F.col(f"`{columns[2]}`").alias("text"),
        )
        for (df, columns), path in zip(named, written, strict=True)
    ])


RESPONSES = """SELECT event_id, '<soap:Envelope xmlns:soap="urn:x"><soap:Body><GetSlaveResponse><GetSlaveResult><Items>'
    || '<Item><Name>Voltage</Name><Value>1</Value><Units>V</Units></Item>'
    || CASE WHEN event_type = 'error' THEN '' ELSE '<Item><Name>Total system power</Name><Value>'
      || CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(value AS STRING) END || '</Value>'
      || CASE WHEN event_id % 11 = 0 THEN '' ELSE '<Units>kW</Units>' END || '</Item>' END
    || '</Items></GetSlaveResult></GetSlaveResponse></soap:Body></soap:Envelope>' AS body FROM {events}"""


def xml_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.named_reading(derive(spark, sf_dir, RESPONSES), ["event_id"], "body")


def xml_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = feeds.xml_items(derive(spark, sf_dir, RESPONSES), ["event_id"], "body")
    return items.groupBy("Name", "Units").agg(F.count("*").alias("n"))


OBJECTS = """SELECT page_id, '{{"Records":[{{"s3":{{"bucket":{{"name":"b' || CAST(page_id % 3 AS STRING)
    || '"}},"object":{{"key":"' || CAST(page_id AS STRING) || '.jpg"}}}}}},{{"s3":{{"bucket":{{"name":"copy"}},"object":{{"key":"'
    || url || '"}}}}}}]}}' AS body FROM {pages}"""


def object_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.object_events(derive(spark, sf_dir, OBJECTS), ["page_id"], "body")


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("updated_at"))


def incremental_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill from 5 January, whose next start is clamped to the day before the run."""
    return updated_in_range(_feed(spark, sf_dir), "2024-01-05", "2024-01-20")


def incremental_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updated_in_range(_feed(spark, sf_dir), None, "2024-01-20")


# Feeds and where they begin; the third has no history, so its first load is yesterday's.
FEEDS = {"click": "2024-01-05", "view": "2024-01-08", "purchase": None}


class Interrupted(Exception):
    """A run that ends between writing a range and entering it."""


def incremental_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three feeds landed on two run days. On the first every run ends once before its entry, so
    a range is landed twice; the ledger shows each record once."""
    path = scratch_dir(spark, "increments")
    ledger, events = Ledger(spark, f"{path}/ledger"), table(spark, sf_dir, "events")

    def interrupt(load: Load) -> None:
        raise Interrupted(load.folder)

    for today in ("2024-01-12", "2024-01-20"):
        for feed, start in FEEDS.items():
            records = events.where(F.col("event_type") == feed).select("event_id", F.col("ts").alias("updated_at"))
            if today == "2024-01-12":
                with suppress(Interrupted):
                    land_next(records, ledger, feed, f"{path}/landed", today, start, before_entry=interrupt)
            catch_up(records, ledger, feed, f"{path}/landed", today, start)
    return ledger.read(records.schema)


def month_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = table(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return chunks_of(bounds, "first", "last", "2001-07-20")


def range_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next start and last covered day of a load that begins on each order's day."""
    today = F.lit("2001-07-20").cast("date")
    day = F.to_date("o_orderdate")
    starts = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("start")).where(F.col("start") < today)
    following = starts.withColumn("following", next_range_start("start", today))
    return following.withColumn("covered", covered_range_end("start", "following", today))


QUERIES = {
    "scan_param": scan_param,
    "json_pages": json_pages,
    "web_report": web_report,
    "web_cost_report": web_cost_report,
    "web_report_files": web_report_files,
    "xml_readings": xml_readings,
    "xml_items": xml_items,
    "object_events": object_events,
    "incremental_cut": incremental_cut,
    "incremental_daily": incremental_daily,
    "incremental_ledger": incremental_ledger,
    "month_chunks": month_chunks,
    "range_ends": range_ends,
}
ORACLES = {
    "scan_param": """SELECT event_id AS id, event_type AS kind, CAST(user_id AS VARCHAR) AS "user" FROM events""",
    "json_pages": sql(RECORDS),
    "web_report": """SELECT event_id AS position, CAST(event_id AS VARCHAR) AS "ga:sessions",
        substr(CAST(ts AS VARCHAR), 1, 10) AS "ga:date", event_type AS "ga:userType", CAST(user_id AS VARCHAR) AS "ga:users",
        CAST(NULL AS VARCHAR) AS "ga:browser" FROM events""",
    "web_cost_report": """SELECT event_id AS position, CAST(event_id AS VARCHAR) AS "ga:transactionId",
        substr(CAST(ts AS VARCHAR), 1, 10) AS "ga:date", CAST(value AS VARCHAR) AS "ga:transactionRevenue" FROM events""",
    "web_report_files": """SELECT 'ga-data(2024-01-01_2024-02-01' AS file, CAST(event_id AS VARCHAR) AS id,
        substr(CAST(ts AS VARCHAR), 1, 10) AS day, event_type AS text FROM events
        UNION ALL SELECT 'ga-cost-data(2024-02-29', CAST(event_id AS VARCHAR), substr(CAST(ts AS VARCHAR), 1, 10), CAST(value AS VARCHAR)
        FROM events""",
    "xml_readings": """SELECT event_id, CASE WHEN event_type = 'error' OR event_id % 11 = 0 OR event_id % 7 = 0 THEN '0.00'
        ELSE CAST(value AS VARCHAR) END AS reading FROM events""",
    "xml_items": """SELECT 'Voltage' AS "Name", 'V' AS "Units", COUNT(*) AS n FROM events
        UNION ALL SELECT 'Total system power', CASE WHEN event_id % 11 <> 0 THEN 'kW' END, COUNT(*) FROM events
        WHERE event_type <> 'error' GROUP BY ALL""",
    "object_events": """SELECT page_id, 'b' || CAST(page_id % 3 AS VARCHAR) AS bucket, CAST(page_id AS VARCHAR) || '.jpg' AS key
        FROM pages UNION ALL SELECT page_id, 'copy', url FROM pages""",
    "incremental_cut": """SELECT event_id, ts AS updated_at FROM events
        WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-19 00:00:00'""",
    "incremental_daily": "SELECT event_id, ts AS updated_at FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-19'",
    "incremental_ledger": """SELECT event_id, ts AS updated_at, event_type AS feed, first, label FROM events
        JOIN (VALUES ('click', DATE '2024-01-05', DATE '2024-01-11', DATE '2024-01-10'),
          ('view', DATE '2024-01-08', DATE '2024-01-11', DATE '2024-01-10'),
          ('click', DATE '2024-01-11', DATE '2024-01-12', DATE '2024-01-11'), ('view', DATE '2024-01-11', DATE '2024-01-12', DATE '2024-01-11'),
          ('purchase', DATE '2024-01-11', DATE '2024-01-12', DATE '2024-01-11'),
          ('click', DATE '2024-01-12', DATE '2024-01-19', DATE '2024-01-18'), ('view', DATE '2024-01-12', DATE '2024-01-19', DATE '2024-01-18'),
          ('purchase', DATE '2024-01-12', DATE '2024-01-19', DATE '2024-01-18'),
          ('click', DATE '2024-01-19', DATE '2024-01-20', DATE '2024-01-19'), ('view', DATE '2024-01-19', DATE '2024-01-20', DATE '2024-01-19'),
          ('purchase', DATE '2024-01-19', DATE '2024-01-20', DATE '2024-01-19')) l(feed, first, until, label)
        ON feed = event_type AND ts >= first AND ts < until""",
    "month_chunks": """SELECT CAST(s AS DATE) AS range_start,
        least(CAST(s + INTERVAL 1 MONTH AS DATE), DATE '2001-07-19') AS range_end
        FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 MONTH)) AS s FROM orders)""",
    "range_ends": """SELECT o_orderkey, start, following, CASE WHEN following < DATE '2001-07-19'
        THEN CAST(following - INTERVAL 1 DAY AS DATE) WHEN start = DATE '2001-07-19' THEN DATE '2001-07-19'
        ELSE DATE '2001-07-18' END AS covered FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start,
          least(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE), DATE '2001-07-19') AS following
          FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '2001-07-20')""",
}
